"""One query per text operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landgrid.llm import (decontamination, jaccard_join, language_id, lexical, packing, pii, quality, runs, secrets, simhash,
                           topk, toxicity, warc)
from landgrid.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_language_id(spark, folder):
    return language_id.identified(read(spark, folder, "documents"))


@query
def op2_pii_surrogates(spark, folder):
    return pii.replaced(read(spark, folder, "documents"))


@query
def op3_packing(spark, folder):
    return packing.documents_packed(read(spark, folder, "documents"))


@query
def op4_quality(spark, folder):
    return quality.rated(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op5_exact_topk(spark, folder):
    return topk.searched(read(spark, folder, "embeddings"))


ORACLE_SQL["op5_exact_topk"] = topk.SQL


@query
def op6_decontamination(spark, folder):
    return decontamination.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op7_toxicity(spark, folder):
    return toxicity.rated(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op8_simhash(spark, folder):
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query
def op9_secrets(spark, folder):
    return secrets.digested(read(spark, folder, "documents"))


@query
def op10_warc(spark, folder):
    return warc.round_trip(spark, read(spark, folder, "pages"))


ORACLE_SQL["op10_warc"] = warc.SQL


@query
def op11_periodic_runs(spark, folder):
    return runs.periodic_runs(read(spark, folder, "documents"), planted=True)


ORACLE_SQL["op11_periodic_runs"] = runs.SQL


@query
def op12_ranked_search(spark, folder):
    return lexical.ranked(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


ORACLE_SQL["op12_ranked_search"] = lexical.SQL


@query
def op13_jaccard_join(spark, folder):
    return jaccard_join.joined(read(spark, folder, "documents"))


ORACLE_SQL["op13_jaccard_join"] = jaccard_join.SQL
