"""Spatial tables derived from the test tables by integer arithmetic.

The statements run unchanged in Spark SQL and DuckDB, so queries and their oracles see the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.functions import geom as G

TABLES = ("nation", "customer", "supplier", "part", "orders", "events", "pages")

SQL = {
    # buildings, 7 per site in a row
    "f_footprint": """
        select o_orderkey bid,
          (cast(floor(o_orderkey/7e0) as bigint)*7919)%20011
            + (o_orderkey%7)*(20+8*(cast(floor(o_orderkey/7e0) as bigint)%3)) x0,
          (cast(floor(o_orderkey/7e0) as bigint)*6271)%20021 y0,
          8+o_orderkey%17 w, 6+o_orderkey%13 h
        from orders""",
    "f_footprint_dup": """
        select bid,x0,y0,w,h from f_footprint
        union all select bid+10000000,x0,y0,w,h from f_footprint where bid%10=0""",
    # address points with dirty coordinates, padded labels and shared locations
    "f_housing": """
        select id, case when id%97=0 then 'n/a' when id%103=5 then concat(cast(px as string),'d')
            when id%107=6 then '0x1p3' else cast(px as string) end x_raw,
          case when id%89=0 then null else cast(py as string) end y_raw, kind
        from (
          select c_custkey id, (c_custkey*7919)%20011+(c_custkey%9)*20-40 px,
            (c_custkey*6271)%20021+(c_custkey%4)*15-10 py,
            case when c_custkey%3=0 then 'Single' when c_custkey%11=0 then 'Other' else ' Multi ' end kind
          from customer
          union all
          select c_custkey+1000000, (c_custkey*7919)%20011+(c_custkey%9)*20-40,
            (c_custkey*6271)%20021+(c_custkey%4)*15-10, ' Multi '
          from customer where c_custkey%50=1) t""",
    "f_point": """
        select id, trim(kind) kind, try_cast(x_raw as double) x, try_cast(y_raw as double) y
        from f_housing
        where x_raw not like '%a%' and x_raw not like '%d' and x_raw not like '%x%' and y_raw is not null
          and trim(kind) in ('Multi','Single')""",
    # cells of 30 m: v1 with 250 as nodata, v2 with -9999 as nodata
    "f_cell": """
        select cx,cy,cx*30+15 xc,cy*30+15 yc,
          case when event_id%23=0 then 250
               else cast((floor(cx/7e0)*13+floor(cy/5e0)*29)%40 as int) end v1,
          case when cast(floor(cx/4e0)+floor(cy/4e0) as int)%3=0 then -9999 else 1 end v2
        from (select event_id, cast(event_id%100 as int) cx, cast(floor(event_id/100e0) as int) cy
              from events) t""",
    "f_ground": """
        select p_partkey gid,(p_partkey*613)%4001 x0,(p_partkey*977)%4003 y0,
          60+p_partkey%90 w,50+p_partkey%70 h from part""",
    "f_layer": """
        select s_suppkey eid,
          case s_suppkey%3 when 0 then 'schools' when 1 then 'cpad' else 'cced' end layer,
          (s_suppkey*1319)%4001 x0,(s_suppkey*733)%4003 y0,100+s_suppkey%160 w,120+s_suppkey%140 h
        from supplier""",
    "f_lonlat": """
        select c_custkey id, -124e0+(c_custkey%1000)/100e0 lon, 32.5e0+(c_custkey%900)/100e0 lat
        from customer""",
    "f_tract": """
        select concat('06',lpad(cast(n_nationkey as string),9,'0')) geoid,
          (n_nationkey%5)*4100 x0,cast(floor(n_nationkey/5e0) as int)*4100 y0, 4100 w, 4100 h
        from nation""",
    "f_manifest": """
        select case page_id%3 when 0 then ' UnitedStates ' when 1 then 'unitedstates' else 'Canada' end location,
          lpad(cast(page_id as string),9,'0') quadkey,
          case when page_id%7=0 then null when page_id%11=0 then concat('ftp://',page_id) else url end url
        from pages""",
    # features of which some are broken in different ways
    "f_geojson_fault": """
        select p_partkey, case when p_partkey%101=0 then 'no JSON' when p_partkey%61=1 then 'no geometry'
            when p_partkey%67=2 then 'not a polygon' when p_partkey%13=3 then 'incomplete coordinates' end fault,
          -p_partkey%10-114 x, 32+p_partkey%9 y
        from part""",
    "f_geojson": """
        select p_partkey, fault, case fault
          when 'no JSON' then '{"type":"Feature","geom'
          when 'no geometry' then case when p_partkey%2=0 then '{"foo":1}' else '{"type":"Feature","geometry":null}' end
          when 'not a polygon' then '{"type":"Feature","geometry":{"type":"Point","coordinates":[1.0,2.0]}}'
          when 'incomplete coordinates' then concat('{"type":"Feature","geometry":{"type":"Polygon","coordinates":',
            case p_partkey%5 when 0 then '"abc"' when 1 then '[]' when 2 then '[[[1.0],[1.0,2.0],[3.0,4.0],[1.0,2.0]]]'
              when 3 then '[[null,[1.0,2.0],[3.0,4.0],[1.0,2.0]]]' else '[[[1.0,2.0],[3.0,4.0]]]' end, '}}')
          else concat('{"type":"Feature","properties":{"height":-1.0},"geometry":{"type":"Polygon","coordinates":[[[',
            x,',',y,'],[',x+1,',',y,'],[',x+1,',',y+1,'],[',x,',',y,']]]}}') end line
        from f_geojson_fault""",
}

# the area whose polygons are kept
BOUNDARY = (3000, 3000, 15000, 15000)


def needed(text: str, known: dict[str, str]) -> list[str]:
    """Names in ``known`` that a statement uses, directly or not, in the order of ``known``."""
    found, todo = set(), [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = [name for name in known if name in words and name not in found]
        found.update(new)
        todo += [known[name] for name in new]
    return [name for name in known if name in found]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A fixture over the Parquet tables in ``folder``."""
    statement = SQL[name]
    chain = needed(statement, SQL)
    for base in needed(" ".join([statement, *(SQL[n] for n in chain)]), {t: "" for t in TABLES}):
        spark.read.parquet(f"{folder}/{base}.parquet").createOrReplaceTempView(base)
    for view in chain:
        spark.sql(SQL[view]).createOrReplaceTempView(view)
    return spark.sql(statement)


def shapes(rectangles: DataFrame) -> DataFrame:
    """Rectangles with ``geom`` in place of corner and sides."""
    rest = [c for c in rectangles.columns if c not in ("x0", "y0", "w", "h")]
    geom = G.rectangle("x0", "y0", F.col("x0") + F.col("w"), F.col("y0") + F.col("h"))
    return rectangles.select(*rest, geom.alias("geom"))
