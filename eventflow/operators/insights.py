"""Batch insights over the raw clickstream (``schemas.RAW_SCHEMA``).

Every aggregate is combinable, so Spark aggregates partially before the shuffle:
a hot item, event type, day or visitor is folded map-side and cannot overload a
single reducer.  ``daily_visitors`` stays exact (two-phase distinct on
``(event_date, visitorid)``), never approximated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.time import (
    long_date_label,
    long_date_label_of_date,
    ms_to_event_time,
    ms_to_instant,
    utc_date,
)


def enrich(df: DataFrame) -> DataFrame:
    """Add ``event_time`` (second precision, ms dropped) and ``event_date`` (UTC).
    Lazy: Catalyst prunes whichever of the two a later step does not use."""
    return df.withColumn("event_time", ms_to_event_time("timestamp")).withColumn(
        "event_date", utc_date("event_time")
    )


def total_events(df: DataFrame) -> DataFrame:
    """All rows, NULLs included."""
    return df.agg(F.count(F.lit(1)).alias("total_events"))


def top_items(df: DataFrame, n: int = 20, event: str = "view") -> DataFrame:
    """The ``n`` items with most ``event`` rows; ties broken by ``itemid`` (text order).

    Plan: pushed filter -> partial count -> shuffle on itemid -> final count ->
    TakeOrderedAndProject (per-partition top-n, then a merge of n rows per partition).
    """
    return (
        df.filter(F.col("event") == F.lit(event))
        .groupBy("itemid")
        .agg(F.count(F.lit(1)).alias("view_count"))
        .orderBy(F.desc("view_count"), F.asc_nulls_first("itemid"))
        .limit(n)
    )


def item_event_counts(df: DataFrame) -> DataFrame:
    """Rows per event type and item: the one pass over raw rows from which the top
    items, the distribution and the total follow (``*_from_counts``)."""
    return df.groupBy("event", "itemid").agg(F.count(F.lit(1)).alias("n"))


def top_items_from_counts(counts: DataFrame, n: int = 20, event: str = "view") -> DataFrame:
    """:func:`top_items` from :func:`item_event_counts`."""
    return (
        counts.filter(F.col("event") == F.lit(event))
        .select("itemid", F.col("n").alias("view_count"))
        .orderBy(F.desc("view_count"), F.asc_nulls_first("itemid"))
        .limit(n)
    )


def event_distribution_from_counts(counts: DataFrame) -> DataFrame:
    """:func:`event_distribution` from :func:`item_event_counts`."""
    return (
        counts.groupBy("event")
        .agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first("event"))
    )


def event_distribution(df: DataFrame) -> DataFrame:
    """Rows per event type, NULL type included, most frequent first."""
    return (
        df.groupBy("event")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first("event"))
    )


def event_share(df: DataFrame) -> DataFrame:
    """``event_distribution`` plus each type's share of all rows in percent.

    The denominator is a scalar subquery over the distribution itself, not an
    un-partitioned window (which would gather the groups into one task) and not a
    second scan of the raw rows: AQE reuses the distribution's shuffle output
    (``ReusedExchange``) for the subquery.
    """
    dist = df.groupBy("event").agg(F.count(F.lit(1)).alias("count"))
    total = dist.agg(F.sum("count").cast("double").alias("n")).scalar()
    return dist.withColumn("share_pct", F.col("count").cast("double") * F.lit(100.0) / total).orderBy(
        F.desc("count"), F.asc_nulls_first("event")
    )


def daily_visitors(df: DataFrame) -> DataFrame:
    """Exact distinct visitors per UTC day; NULL visitors are not counted, a NULL
    day is its own group and sorts first."""
    enriched = df if "event_date" in df.columns else enrich(df)
    return (
        enriched.groupBy("event_date")
        .agg(F.count_distinct("visitorid").alias("active_visitors"))
        .orderBy(F.asc_nulls_first("event_date"))
    )


def coverage(df: DataFrame, source: str = "csv") -> DataFrame:
    """First and last event instant, number of non-NULL timestamps and a status:
    ``source`` when there are timestamps, ``empty`` otherwise.  One row."""
    n = F.count("timestamp")
    return df.agg(
        ms_to_instant(F.min("timestamp")).alias("min_ts"),
        ms_to_instant(F.max("timestamp")).alias("max_ts"),
        n.alias("n_events"),
        F.when(n > 0, F.lit(source)).otherwise(F.lit("empty")).alias("source"),
    )


def coverage_labels(cov: DataFrame) -> DataFrame:
    """Long-form labels of a ``coverage`` row, ``-`` when unknown."""
    return cov.select(
        long_date_label("min_ts").alias("earliest"),
        long_date_label("max_ts").alias("latest"),
    )


def date_window(daily: DataFrame) -> DataFrame:
    """First day, last day and number of distinct days of ``daily_visitors``."""
    return daily.agg(
        F.min("event_date").alias("first_day"),
        F.max("event_date").alias("last_day"),
        F.count_distinct("event_date").alias("n_days"),
    )


def date_window_labels(window: DataFrame) -> DataFrame:
    """Long-form labels of a ``date_window`` row, ``-`` when unknown."""
    return window.select(
        long_date_label_of_date("first_day").alias("first_label"),
        long_date_label_of_date("last_day").alias("last_label"),
        "n_days",
    )
