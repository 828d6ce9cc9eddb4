import math

import pytest
from pyspark.sql import functions as F

from eventflow.llm.mixing import distribution, mix_sources, target_rates


def test_distribution_function(spark):
    for mean in (0.0, 0.3, 5.0, 32.0):
        got = spark.range(1).select(distribution(F.lit(mean)).alias("c")).first()["c"]
        want, p = 0.0, math.exp(-mean)
        for k, c in enumerate(got):
            want += p
            p *= mean / (k + 1)
            assert c == pytest.approx(want, abs=1e-12)
        assert got[-1] == pytest.approx(1.0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 4000, "big").when(F.col("id") < 5900, "mid").when(F.col("id") < 5990, "small").alias("source"),
        F.lit("abcde").alias("text"), F.col("id").alias("rate_cdf"))


def test_weights_are_met_and_rows_kept_whole(docs):
    out = mix_sources(docs, weights={"big": 1, "mid": 2, "small": 3, None: 1, "absent": 5}).cache()
    assert out.columns == docs.columns + ["n_copies", "copy", "order_key"]
    size = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    total = 6000 / 7  # the weights of the sources that are there
    for source, weight in {"big": 1, "mid": 2, "small": 3, None: 1}.items():
        mean = total * weight
        assert abs(size[source] - mean) < 5 * math.sqrt(mean), source
    by_row = out.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("d"), F.max("n_copies").alias("m"))
    assert by_row.filter("n <> m OR d <> m").isEmpty()
    # a Poisson law: mean and variance agree (rate 1000/10 for the null source)
    again = mix_sources(docs, weights={"big": 1, "mid": 2, "small": 3, None: 1, "absent": 5})
    assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()
    assert not mix_sources(docs, weights={"big": 1}, seed=7).exceptAll(mix_sources(docs, weights={"big": 1})).isEmpty()


def test_order_is_global_and_pseudo_random(docs):
    rows = mix_sources(docs, weights={"big": 1, "mid": 1}).select("source", F.spark_partition_id().alias("p"), "order_key").collect()
    for p in {r["p"] for r in rows}:
        keys = [r["order_key"] for r in rows if r["p"] == p]
        assert keys == sorted(keys)
        share = sum(r["source"] == "big" for r in rows if r["p"] == p) / len(keys)
        assert 0.35 < share < 0.65


def test_edge_cases(spark, docs):
    schema = "doc_id long, source string, text string"
    assert mix_sources(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "a", None), (None, "a", "xx"), (None, "a", "xx"), (2, None, "y"), (2, None, "y"), (3, "e", ""), (4, "b", "z" * 200_000)]
    out = mix_sources(spark.createDataFrame(rows, schema), scale=4.0).collect()
    assert {r["source"] for r in out} <= {"a", "b", None}
    # repeated rows are drawn alike
    for key in (None, 2):
        n = [r["copy"] for r in out if r["doc_id"] == key]
        assert all(n.count(c) == 2 for c in set(n))
    rates = {r["source"]: r for r in target_rates(spark.createDataFrame(rows, schema)).collect()}
    assert rates["e"]["rate"] == 0.0 and rates["a"]["characters"] == 4 and rates[None]["documents"] == 2


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", "x", 7, "o"), (2, "a", "y", 8, "p")], "doc_id long, source string, text string, copy int, ORDER_KEY string")
    out = mix_sources(docs, scale=5.0)
    assert out.columns == docs.columns + ["n_copies", "_copy", "_order_key"]
    assert {r["copy"] for r in out.collect()} <= {7, 8}


def test_rows_without_ids_meet_their_target(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("only").alias("source"), F.concat(F.lit("text "), "id").alias("text"))
    for scale in (1.0, 2.0, 3.0):
        out = mix_sources(docs, scale=scale)
        rows = out.select(F.spark_partition_id().alias("p"), "order_key", "text").collect()
        assert abs(len(rows) - scale * 20_000) < 0.03 * scale * 20_000
        keys = [r["order_key"] for r in rows]
        assert len(set(keys)) > 0.99 * len(keys)  # no key gathers rows in one task
        parts = {r["p"] for r in rows}
        assert max(sum(r["p"] == p for r in rows) for p in parts) < 1.5 * len(rows) / len(parts)
