"""Plan guards for the training-data queries: what a plan must not hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from eventflow.llm.exact_dedup import exact_duplicates
from eventflow.llm.mixing import mix_sources
from eventflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL

# a product of tables, rows handed to Python one by one, or whole groups in one Python call
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas",
             "CollectLimit")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_and_no_rows_one_by_one(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    assert "LocalTableScan" not in plan  # the result comes from the tables, not from the driver


@pytest.mark.parametrize("name, table, columns", [
    ("op2_token_counts", "documents", {"doc_id", "text"}),
    ("op3_packing", "documents", {"doc_id", "text"}),
    ("op5_toxicity", "documents", {"doc_id", "text"}),
    ("op9_quality_rules", "documents", {"doc_id", "text"}),
    ("op10_html_extraction", "pages", {"page_id", "url", "html"}),
    ("op12_quality_classifier", "documents", {"doc_id", "text"}),
])
def test_one_scan_of_the_columns_needed(spark, name, table, columns):
    """What is left to do once samples and models are there: one pass, no shuffle."""
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    assert [{c.split("#")[0] for c in s.split(",")} for s in scans] == [columns]
    assert "Exchange" not in plan and "Limit" not in plan


@pytest.mark.parametrize("make", [exact_duplicates, mix_sources])
def test_joins_of_large_sides_are_not_broadcast_by_hint(spark, make):
    """A side may be broadcast by its measured size only: without that, nothing is."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    spark.conf.set(adaptive, "-1")
    try:
        df = make(docs)
        assert "BroadcastHashJoin" not in plan_of(df)
        rows = df.count()
    finally:
        spark.conf.set(key, old)
        spark.conf.unset(adaptive)
    assert make(docs).count() == rows


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op6_near_duplicates", "op8_source_mixing", "op13_spelling_variants"])
def test_results_do_not_depend_on_partitioning(spark, name):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    got = []
    try:
        for n in ("1", "7"):
            spark.conf.set(key, n)
            df = QUERIES[name](spark, SF_SMALL)
            got.append(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())
    finally:
        spark.conf.set(key, old)
    assert got[0] == got[1]
