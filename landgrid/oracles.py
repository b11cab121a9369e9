"""The catalog's queries as plain SQL for DuckDB, over points, rectangles and cells.

They share no code with the operators: spatial joins are range joins, components are a recursive
query, and the polygon difference cuts rectangles at all borders of their matches.
"""

from __future__ import annotations

import math

from landgrid import fixtures


def gap(a: str, b: str) -> str:
    """Distance of two rectangles with columns x0, y0, w, h."""
    return (f"sqrt(power(greatest({a}.x0-{b}.x0-{b}.w, 0, {b}.x0-{a}.x0-{a}.w),2)"
            f"+power(greatest({a}.y0-{b}.y0-{b}.h, 0, {b}.y0-{a}.y0-{a}.h),2))")


def point_gap(a: str, p: str) -> str:
    return (f"sqrt(power(greatest({a}.x0-{p}.x, 0, {p}.x-{a}.x0-{a}.w),2)"
            f"+power(greatest({a}.y0-{p}.y, 0, {p}.y-{a}.y0-{a}.h),2))")


def close(a: str, p: str, reach: float) -> str:
    return (f"{p}.x between {a}.x0-{reach} and {a}.x0+{a}.w+{reach}"
            f" and {p}.y between {a}.y0-{reach} and {a}.y0+{a}.h+{reach} and {point_gap(a, p)} <= {reach}")


def meet(a: str, b: str, reach: float = 0) -> str:
    return (f"{a}.x0 <= {b}.x0+{b}.w+{reach} and {b}.x0 <= {a}.x0+{a}.w+{reach}"
            f" and {a}.y0 <= {b}.y0+{b}.h+{reach} and {b}.y0 <= {a}.y0+{a}.h+{reach}")


def rect_box(a: str = "") -> str:
    a = f"{a}." if a else ""
    return (f"cast({a}x0 as double) xmin, cast({a}y0 as double) ymin,"
            f" cast({a}x0+{a}w as double) xmax, cast({a}y0+{a}h as double) ymax")


def components(nodes: str, edges: str) -> str:
    """Smallest node per component: ``id, comp`` (body of a USING KEY recursion)."""
    return f"""select id, id comp from ({nodes})
        union
        (select e.v, min(c.comp)
         from cc c join ({edges}) e on e.u = c.id join recurring.cc o on o.id = e.v
         where c.comp < o.comp group by e.v)"""


def candidates(view: str, name: str) -> dict[str, str]:
    return {
        f"{name}_hit": f"select distinct a.bid from {view} a join o_multi p on {close('a', 'p', 0)}",
        f"{name}_near": f"""select distinct a.bid from {view} a join o_single p on {close('a', 'p', 30)}
            where not exists (select 1 from {name}_hit h where h.bid = a.bid)""",
        f"{name}_candidate": f"""select a.* from {view} a
            where not exists (select 1 from {name}_near n where n.bid = a.bid)""",
        f"{name}_nearest": f"""select bid, id, distance from (
              select a.bid, p.id, {point_gap('a', 'p')} distance,
                rank() over (partition by a.bid order by {point_gap('a', 'p')}) place
              from {name}_candidate a join o_multi p on {close('a', 'p', 100)}) r
            where place = 1""",
    }


def density(name: str, eps: int, least: int) -> dict[str, str]:
    """Close pairs of building centres, core points and the links between them."""
    return {
        f"o_near{name}": f"""select a.bid u, b.bid v from o_middle a join o_middle b
            on b.x between a.x-{eps} and a.x+{eps} and b.y between a.y-{eps} and a.y+{eps}
            and sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)) <= {eps}""",
        f"o_core{name}": f"select u bid from o_near{name} group by u having count(*) >= {least}",
        f"o_core_edge{name}": f"""select u, v from o_near{name} n where exists (select 1 from o_core{name} c where c.bid = n.u)
            and exists (select 1 from o_core{name} c where c.bid = n.v)""",
    }


def density_labels(name: str) -> str:
    return f"""select m.bid fid, coalesce(c.comp, (
            select min(k.comp) from o_near{name} n join cc k on k.id = n.v where n.u = m.bid), -1) "cluster"
        from o_middle m left join cc c on c.id = m.bid"""


LIGHT = "v1 between 1 and 20"
NEIGHBOURS = "b.cx between a.cx-1 and a.cx+1 and b.cy between a.cy-1 and a.cy+1"

# statements that others build on
PARTS = {
    "o_tile": """select location, quadkey, url from f_manifest
        where lower(trim(location)) = 'unitedstates' and url is not null and starts_with(url, 'http')""",
    "o_tile_file": r"""select *, concat('quadkey_', quadkey, '_',
          list_last(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'))) file_name
        from o_tile""",
    "o_multi": "select id, x, y from f_point where kind = 'Multi'",
    "o_single": "select id, x, y from f_point where kind = 'Single'",
    **candidates("f_footprint", "o_plain"),
    **candidates("f_footprint_dup", "o_dup"),
    "o_pair": f"""select a.bid u, b.bid v from f_footprint a join f_footprint b
        on a.bid < b.bid and {meet('a', 'b', 24)} and {gap('a', 'b')} <= 24""",
    "o_numbered": "select id bid, comp component, dense_rank() over (order by comp) - 1 cluster from cc",
    "o_center": """select cluster, component, avg(x) x, avg(y) y from (
          select distinct n.cluster, n.component, f.x0+f.w/2e0 x, f.y0+f.h/2e0 y
          from o_numbered n join f_footprint f using (bid)) d group by cluster, component""",
    "o_window": "select min(x) x0, max(x) x1, min(y) y0, max(y) y1 from o_multi",
    "o_aoi": """select distinct c.cx, c.cy, c.v1 from f_cell c join o_multi p
        on p.x between c.xc-250 and c.xc+250 and p.y between c.yc-250 and c.yc+250
        and sqrt(power(p.x-c.xc,2)+power(p.y-c.yc,2)) <= 250""",
    "o_light": f"select cx, cy from o_aoi where {LIGHT}",
    "o_eroded": f"""select a.cx, a.cy from o_light a join o_light b on {NEIGHBOURS}
        group by a.cx, a.cy having count(*) = 9""",
    "o_opened": f"""select distinct cast(b.cx as bigint) cx, cast(b.cy as bigint) cy
        from o_eroded a join o_light b on {NEIGHBOURS}""",
    "o_spot": "select cx, cy, cy*4294967296 + cx id from o_opened",
    "o_touch": """select a.id u, b.id v from o_spot a join o_spot b
        on abs(a.cx-b.cx) + abs(a.cy-b.cy) = 1 and b.cx between a.cx-1 and a.cx+1 and b.cy between a.cy-1 and a.cy+1""",
    "o_region": "select s.cx, s.cy, c.comp region from o_spot s join cc c on c.id = s.id",
    "o_ground_tract": f"""select g.gid, t.geoid, cast(g.w*g.h as double) area_sqm
        from f_ground g join f_tract t on {meet('g', 't')}""",
    "o_roof_tract": f"""select f.bid, t.geoid, cast(f.w*f.h as double) area_sqm
        from f_footprint f join f_tract t on {meet('f', 't')}""",
    "o_summary": """select coalesce(g.geoid, r.geoid) census_tract_id,
          coalesce(g.area, 0) ground_total_area_sqm, coalesce(g.n, 0) ground_polygon_count,
          coalesce(r.area, 0) rooftop_total_area_sqm, coalesce(r.n, 0) rooftop_polygon_count
        from (select geoid, sum(area_sqm) area, count(*) n from o_ground_tract group by geoid) g
        full join (select geoid, sum(area_sqm) area, count(*) n from o_roof_tract group by geoid) r
        on g.geoid = r.geoid""",
    "o_shown": """select t.geoid, t.x0, t.y0, t.w, t.h, s.* from f_tract t join o_summary s
        on s.census_tract_id = t.geoid where s.ground_polygon_count > 0 or s.rooftop_polygon_count > 0""",
    # ground rectangles cut at all borders of the exclusions they meet
    "o_match": f"""select g.gid, greatest(e.x0, g.x0) x0, least(e.x0+e.w, g.x0+g.w) x1,
          greatest(e.y0, g.y0) y0, least(e.y0+e.h, g.y0+g.h) y1
        from f_ground g join f_layer e on {meet('g', 'e')}""",
    "o_cut_x": """select gid, x x0, lead(x) over (partition by gid order by x) x1 from (
          select gid, x0 x from f_ground union select gid, x0+w from f_ground
          union select gid, x0 from o_match union select gid, x1 from o_match) c""",
    "o_cut_y": """select gid, y y0, lead(y) over (partition by gid order by y) y1 from (
          select gid, y0 y from f_ground union select gid, y0+h from f_ground
          union select gid, y0 from o_match union select gid, y1 from o_match) c""",
    "o_rest": """select x.gid, x.x0, x.x1, y.y0, y.y1 from o_cut_x x join o_cut_y y on x.gid = y.gid
        where x.x1 is not null and y.y1 is not null and not exists (
          select 1 from o_match m where m.gid = x.gid
          and m.x0 <= x.x0 and m.x1 >= x.x1 and m.y0 <= y.y0 and m.y1 >= y.y1)""",
    # rectangles with a hole at (1, 1) of a quarter of each side
    "o_holed": """select gid, x0, y0, w, h, w/4e0 hw, h/4e0 hh from f_ground""",
    # centres of buildings with their number of neighbours within 60 m
    "o_middle": "select bid, x0+w/2e0 x, y0+h/2e0 y from f_footprint",
    **density("", 60, 5), **density("_60_1", 60, 1), **density("_100_5", 100, 5),
}

BUILDING_COMPONENTS = components(
    "select bid id from f_footprint", "select u, v from o_pair union all select v, u from o_pair")
CORE_COMPONENTS = {f"density_clusters{n}": components(f"select bid id from o_core{n}", f"select u, v from o_core_edge{n}")
                   for n in ("", "_60_1", "_100_5")}
REGION_COMPONENTS = components("select id from o_spot", "select u, v from o_touch")


def albers_constants(origin: float = 0, first: float = 34, second: float = 40.5) -> tuple[float, ...]:
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q_of(s):
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    s1, s2 = math.sin(math.radians(first)), math.sin(math.radians(second))
    m1, m2 = (math.sqrt((1 - s * s) / (1 - e2 * s * s)) for s in (s1, s2))
    n = (m1 * m1 - m2 * m2) / (q_of(s2) - q_of(s1))
    c = m1 * m1 + n * q_of(s1)
    return a, e2, e, n, c, a * math.sqrt(c - n * q_of(math.sin(math.radians(origin)))) / n


def albers_degrees(source: str, x: str, y: str, keep: str, steps: int = 8) -> str:
    """Longitude and latitude of points in the state's system; the latitude by iteration."""
    a, e2, e, n, c, rho0 = albers_constants()
    north = f"({rho0!r}-({y}+4000000))"
    rows = f"""select {keep}, -120+degrees(atan2({x},{north})/{n!r}) lon,
        ({c!r}-power({n!r}/{a},2)*(power({x},2)+power({north},2)))/{n!r} q from {source}"""
    rows = f"select {keep}, lon, q, asin(q/2) p from ({rows}) r"
    for _ in range(steps):
        s = "sin(p)"
        rows = f"""select {keep}, lon, q, p + power(1-{e2!r}*{s}*{s},2)/(2*cos(p))*(q/{1 - e2!r} - {s}/(1-{e2!r}*{s}*{s})
            + ln((1-{e!r}*{s})/(1+{e!r}*{s}))/{2 * e!r}) p from ({rows}) r"""
    return f"select {keep}, lon, degrees(p) lat from ({rows}) r"


def albers(lon: str, lat: str, meridian: float = -120, false_north: float = -4000000, origin: float = 0,
           first: float = 34, second: float = 40.5) -> tuple[str, str]:
    a, e2, e, n, c, rho0 = albers_constants(origin, first, second)
    s = f"sin(radians({lat}))"
    q = f"({1 - e2!r}*({s}/(1-{e2!r}*{s}*{s}) - ln((1-{e!r}*{s})/(1+{e!r}*{s}))/{2 * e!r}))"
    rho, theta = f"({a}*sqrt({c!r}-{n!r}*{q})/{n!r})", f"({n!r}*radians({lon}-({meridian})))"
    return f"{rho}*sin({theta})", f"{rho0!r}+({false_north})-{rho}*cos({theta})"


def utm(lon: str, lat: str) -> tuple[str, str]:
    a, f = 6378137.0, 1 / 298.257222101
    n = f / (2 - f)
    k = 0.9996 * a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
             13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
             61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    g = 2 * math.sqrt(n) / (1 + n)
    s = f"sin(radians({lat}))"
    inner = f"(ln((1+{s})/(1-{s}))/2-{g!r}*ln((1+{g!r}*{s})/(1-{g!r}*{s}))/2)"
    t = f"((exp({inner})-exp(-{inner}))/2)"
    d = f"radians({lon}+123)"
    xi = f"atan2({t},cos({d}))"
    r = f"(sin({d})/sqrt(1+{t}*{t}))"
    eta = f"(ln((1+{r})/(1-{r}))/2)"
    x, y = "p.eta", "p.xi"
    for j, v in enumerate(alpha, 1):
        sinh, cosh = (f"((exp({2 * j}*p.eta){sign}exp(-{2 * j}*p.eta))/2)" for sign in "-+")
        x += f"+{v!r}*cos({2 * j}*p.xi)*{sinh}"
        y += f"+{v!r}*sin({2 * j}*p.xi)*{cosh}"
    return f"select id, {xi} xi, {eta} eta from f_lonlat", f"round(500000+{k!r}*({x}),3) x, round({k!r}*({y}),3) y"


def _utm_statement() -> str:
    source, columns = utm("lon", "lat")
    return f"select p.id, {columns} from ({source}) p"


ALBERS_X, ALBERS_Y = albers("lon", "lat")
CONUS = albers("lon", "lat", -96, 0, 23, 29.5, 45.5)
DEGREE_BOX = "min(lon) xmin, min(lat) ymin, max(lon) xmax, max(lat) ymax"
ROUND_BOX = "round(xmin, 6) xmin, round(ymin, 6) ymin, round(xmax, 6) xmax, round(ymax, 6) ymax"
DISC = 32 * math.sin(math.pi / 32)

REGION_POLYGONS = """select a.region, cast(min(a.cx)*30 as double) xmin, cast(min(a.cy)*30 as double) ymin,
          cast(max(a.cx)*30+30 as double) xmax, cast(max(a.cy)*30+30 as double) ymax,
          cast(count(*)*900 as double) area, cast(sum(4-a.n)*30 as double) border
        from (select r.cx, r.cy, r.region, count(b.cx) n from o_region r left join o_region b
              on b.region = r.region and abs(b.cx-r.cx)+abs(b.cy-r.cy) = 1
              group by r.cx, r.cy, r.region) a group by a.region"""

STATEMENTS = {
    "manifest_scan": "select location, quadkey, url from f_manifest",
    "manifest_filter": 'select location, quadkey as "QuadKey", url as "Url" from o_tile',
    "manifest_files": "select file_name from o_tile_file",
    "manifest_missing": """select quadkey as "QuadKey", file_name from o_tile_file
        where file_name not in (select file_name from o_tile_file where location = 'unitedstates')""",
    "geojson_scan": """select p_partkey, 4 vertices, cast(x as double) xmin, cast(y as double) ymin,
          cast(x+1 as double) xmax, cast(y+1 as double) ymax, 0.5e0 area from f_geojson_fault where fault is null""",
    "geojson_quarantine": "select p_partkey, line, fault reason from f_geojson where fault is not null",
    "quarantine_sample": """select p_partkey, line, fault reason from f_geojson
        where fault is not null order by p_partkey limit 5""",
    "housing_scan": 'select id as "ID", x_raw lon, y_raw lat, kind single_or_multi from f_housing',
    "housing_multi": """select id as "ID" from f_housing where trim(kind) = 'Multi'""",
    "housing_single": """select id as "ID" from f_housing where trim(kind) = 'Single'""",
    "housing_clean": """select id as "ID", try_cast(x_raw as double) lon, try_cast(y_raw as double) lat from f_housing
        where regexp_full_match(x_raw, '[-0-9.]+') and regexp_full_match(y_raw, '[-0-9.]+')""",
    "housing_points": 'select id as "ID", x, y from o_multi',
    "stage_metrics": """select 'read' stage, count(*) as "rows" from f_housing
        union all select 'multi', count(*) from f_housing where trim(kind) = 'Multi'
        union all select 'located', count(*) from o_multi""",
    "row_ids": "select bid, row_number() over (order by x0, y0, bid) - 1 row_id from f_footprint",
    "polygon_area": "select bid fid, cast(w*h as double) area from f_footprint",
    "polygon_centroid": """select gid,
          round((w*h*(x0+w/2e0) - hw*hh*(x0+1+hw/2)) / (w*h-hw*hh), 3) x,
          round((w*h*(y0+h/2e0) - hw*hh*(y0+1+hh/2)) / (w*h-hw*hh), 3) y,
          round(w*h-hw*hh, 3) area from o_holed""",
    "polygon_bbox": f"select gid, {rect_box()} from f_ground",
    "point_buffer": f"""select id as "ID", 65 vertices, round({DISC * 250 * 250!r}e0, 3) area,
          x-250 xmin, y-250 ymin, x+250 xmax, y+250 ymax from o_multi""",
    "polygon_buffer_area": f"select bid fid, round(w*h + 10*(w+h) + {25 * DISC!r}e0, 3) area from f_footprint",
    "explode_parts": f"""select eid, part, {rect_box()}, cast(w*h as double) area from (
          select eid, 0 part, x0, y0, w, h from f_layer
          union all select eid, 1, x0+2000, y0, w, h from f_layer) p""",
    "simplify_bounds": f"select bid, 5 vertices, {rect_box()}, cast(w*h as double) area from f_footprint",
    "valid_filter_holes": """select gid from f_ground
        where gid%71 > 0 and gid%53 > 0 and gid%71+8 < w and gid%53+8 < h
          and (gid%71 > 15 or gid%53 > 15 or (gid%71 = 15 and gid%53 = 15))""",
    "valid_filter": "select gid from f_ground where w%3 <> 0 and h%5 <> 0",
    "layer_extent": """select cast(min(x0) as double) xmin, cast(min(y0) as double) ymin,
        cast(max(x0+w) as double) xmax, cast(max(y0+h) as double) ymax from f_footprint""",
    "project_albers": f"select id, round({ALBERS_X},3) x, round({ALBERS_Y},3) y from f_lonlat",
    "project_utm": _utm_statement(),
    "project_inverse": """select id, round(lon,7) lon0, round(lat,7) lat0, round(lon,7) lon1, round(lat,7) lat1
        from f_lonlat""",
    "boundary_select": f"""select geoid as name, {rect_box()}, cast(w*h as double) area
        from f_tract where geoid = '06000000007'""",
    "boundary_filter": """select bid fid from f_footprint
        where x0 <= 15000 and x0+w >= 3000 and y0 <= 15000 and y0+h >= 3000""",
    "footprint_dedup": f"select {rect_box()} from (select distinct x0, y0, w, h from f_footprint_dup) d",
    "distinct_footprints_inside": f"""select {rect_box()} from (select distinct x0, y0, w, h from f_footprint_dup
        where x0 <= 15000 and x0+w >= 3000 and y0 <= 15000 and y0+h >= 3000) d""",
    "footprint_hits": "select bid fid from o_plain_hit",
    "near_single": "select bid fid from o_plain_near",
    "rooftop_candidates": "select bid fid from o_plain_candidate",
    "nearest_multi": 'select bid fid, id as "ID", round(distance, 3) distance from o_plain_nearest',
    "rooftop_unique": f"""select min(n.id) as "ID", {rect_box('a')} from o_dup_nearest n
        join f_footprint_dup a on a.bid = n.bid group by a.x0, a.y0, a.w, a.h""",
    "proximity_pairs": "select u, v from o_pair",
    "rooftop_components": "select id fid, comp component from cc",
    "rooftop_clusters": "select bid fid, cast(cluster as int) cluster from o_numbered",
    **{f"density_clusters{n}": density_labels(n) for n in ("", "_60_1", "_100_5")},
    "exclusion_union": """select case when layer = 'schools' then eid end school,
          case when layer <> 'schools' then eid end eid, layer, x0, y0, w, h from f_layer""",
    "overlay_difference": """select gid, cast(min(x0) as double) xmin, cast(min(y0) as double) ymin,
        cast(max(x1) as double) xmax, cast(max(y1) as double) ymax from o_rest group by gid""",
    "overlay_difference_area": """select gid, cast(sum((x1-x0)*(y1-y0)) as double) area from o_rest group by gid""",
    "ground_min_area": "select bid fid from f_footprint where w*h >= 100",
    "ground_raster_overlap": """select distinct g.gid, true has_impervious_overlap from f_ground g join f_cell c
        on c.xc between g.x0 and g.x0+g.w and c.yc between g.y0 and g.y0+g.h where c.v2 <> -9999""",
    "raster_crop": """select c.cx, c.cy, c.v1 as "value" from f_cell c, o_window b
        where c.cx between floor((b.x0-250)/30) and floor((b.x1+250)/30)
        and c.cy between floor((b.y0-250)/30) and floor((b.y1+250)/30)""",
    "raster_binary": f"select cx, cy from f_cell where {LIGHT}",
    "aoi_cells": "select cx, cy from o_aoi",
    "raster_erode": "select cast(cx as bigint) cx, cast(cy as bigint) cy from o_eroded",
    "raster_open": "select cx, cy from o_opened",
    "raster_regions": "select cx, cy, region from o_region",
    "region_polygons": REGION_POLYGONS,
    "region_polygons_small_blocks": REGION_POLYGONS,
    # keys in runs without a gap, cut at multiples of 10,000
    "chain_components": """select bid, min(bid) over (partition by run) component from (
          select bid, sum(first) over (order by bid) run from (
            select bid, case when bid - 1 <> lag(bid) over (order by bid) then 1 else 0 end first
            from (select distinct bid from f_footprint) k) c) r""",
    "manifest_file": "select location, quadkey, url from f_manifest",
    "tile_files": """select cast(p_partkey%10 as string) quadkey, count(*) shapes, count(*)*0.5e0 area
        from f_geojson_fault where fault is null group by p_partkey%10""",
    "tile_faults": """select cast(p_partkey%10 as string) quadkey, fault reason, count(*) "count"
        from f_geojson_fault where fault is not null group by p_partkey%10, fault""",
    "landed_tiles": """select cast(p_partkey%10 as string) quadkey, cast(1 as bigint) files
        from f_geojson group by p_partkey%10""",
    "layer_window": f"""select eid, layer, {rect_box()} from f_layer
        where x0 <= 1900 and x0+w >= 1000 and y0 <= 1500 and y0+h >= 700""",
    "housing_file": 'select id as "ID", x_raw lon, y_raw lat, kind single_or_multi from f_housing',
    "layer_files": f"""select case when layer = 'schools' then eid end school,
          case when layer <> 'schools' then eid end eid, layer, {rect_box()}, 'none' skipped from f_layer""",
    "cell_files": 'select cx, cy, v1 as "value" from f_cell where cx between 20 and 60 and cy between 30 and 80',
    "summary_file": "select * from o_summary",
    "feature_file": """select cast(eid as bigint) eid, round(x0/1e5-120, 5) xmin, round(y0/1e5+36, 5) ymin,
        round((x0+w)/1e5-120, 5) xmax, round((y0+h)/1e5+36, 5) ymax from f_layer""",
    "tract_join_ground": 'select gid, geoid as "GEOID", area_sqm from o_ground_tract',
    "tract_join_rooftop": 'select bid fid, geoid as "GEOID", area_sqm from o_roof_tract',
    "tract_summary": "select * from o_summary",
    "map_feed": f"""select geoid as "GEOID", metric, title, "value", {ROUND_BOX} from (
          select *, 'rooftop_polygon_count' metric, 'Number of Rooftop Polygons' title,
            cast(rooftop_polygon_count as double) "value" from o_shown
          union all select *, 'ground_polygon_count', 'Number of Ground Polygons', ground_polygon_count from o_shown
          union all select *, 'rooftop_total_area_sqm', 'Total Rooftop Area (sqm)', rooftop_total_area_sqm from o_shown
          union all select *, 'ground_total_area_sqm', 'Total Ground Area (sqm)', ground_total_area_sqm from o_shown) u
          join (select geoid corner_id, {DEGREE_BOX} from o_corner group by geoid) c on c.corner_id = u.geoid""",
    "map_extent": f"""select {ROUND_BOX}, round((xmin+xmax)/2, 6) center_lon, round((ymin+ymax)/2, 6) center_lat
        from (select {DEGREE_BOX} from o_corner) e""",
    "aoi_cells_conus": """select distinct cx, cy from (
          select x, y, cx, unnest(range(cast(floor((y+7-60)/30) as bigint), cast(floor((y+7+60)/30) as bigint)+1)) cy from (
            select x, y, unnest(range(cast(floor((x-15-60)/30) as bigint), cast(floor((x-15+60)/30) as bigint)+1)) cx from o_conus) a) b
        where sqrt(power(cx*30+30-x,2)+power(cy*30+8-y,2)) <= 60""",
    "cluster_centers": """select cast(cluster as int) cluster, round(x, 3) x, round(y, 3) y from o_center""",
    "cluster_ground_join": f"""select cast(n.cluster as int) cluster, {rect_box('g')} from (
          select g.gid, min(c.cluster) cluster from f_ground g join o_center c on {close('g', 'c', 150)}
          group by g.gid) n join f_ground g on g.gid = n.gid""",
    "rooftop_area_by_tract": f"""select t.geoid as "GEOID", sum(cast(a.w*a.h as double)) rooftop_total_area_sqm,
          count(*) rooftop_polygon_count
        from (select distinct c.x0, c.y0, c.w, c.h from o_plain_candidate c
              join o_plain_nearest n on n.bid = c.bid) a
        join f_tract t on {meet('a', 't')} group by t.geoid""",
}

PARTS |= {
    "o_corner": albers_degrees("""(select geoid, cast(x0 as double) x, cast(y0 as double) y from o_shown
          union all select geoid, x0+w, y0 from o_shown union all select geoid, x0+w, y0+h from o_shown
          union all select geoid, x0, y0+h from o_shown) v""", "x", "y", "geoid"),
    "o_conus": f"select {CONUS[0]} x, {CONUS[1]} y from f_lonlat",
}

# which components a statement means by ``cc``
COMPONENTS = {
    "raster_regions": REGION_COMPONENTS, "region_polygons": REGION_COMPONENTS,
    "region_polygons_small_blocks": REGION_COMPONENTS, **CORE_COMPONENTS,
}


def statement(name: str) -> str:
    """A complete statement: all the fixtures and parts it needs as common table expressions."""
    known = {**fixtures.SQL, **PARTS, "cc": COMPONENTS.get(name, BUILDING_COMPONENTS)}
    used = set(fixtures.needed(STATEMENTS[name], known))
    recursive = "cc" in used
    order, placed = [], set()

    def place(part):
        if part not in placed:
            placed.add(part)
            for other in fixtures.needed(known[part], {k: "" for k in known}):
                if other != part:
                    place(other)
            order.append(part)

    for part in known:
        if part in used:
            place(part)
    head = {"cc": "cc(id, comp) using key (id)"}
    listed = ",\n".join(f"{head.get(part, part)} as ({known[part]})" for part in order)
    if not listed:
        return STATEMENTS[name]
    return f"with {'recursive ' if recursive else ''}{listed}\n{STATEMENTS[name]}"


def statements() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS}
