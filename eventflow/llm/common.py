"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.session import scratch_path

# ASCII-space words: maximal runs of characters other than space and \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the cluster's shared checkpoint folder and read it back:
    later steps reuse it, it survives lost executors, and its size is known to the
    optimiser (joins with it can be broadcast or split when skewed)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that ``df`` does not use yet (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        candidate = name
        while candidate.lower() in used:
            candidate = f"_{candidate}"
        used.add(candidate.lower())
        out.append(candidate)
    return out


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def worker_cache(key, make):
    """An object that later tasks of the same Python worker process find again (Spark
    reuses its workers).  For things that hold nothing but what can be made anew, such
    as a loaded tokenizer; ``make`` builds it where it is missing."""
    import sys
    import types

    store = sys.modules.setdefault("eventflow_worker_cache", types.ModuleType("eventflow_worker_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def by_size(sizes, limit: int = 4_000_000):
    """Split a sequence of sizes into runs of about ``limit`` in all (at least one item
    each), so that per-batch arrays stay bounded however long the texts are."""
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def by_chars(texts, limit: int = 2_000_000):
    return by_size([len(t) for t in texts], limit)
