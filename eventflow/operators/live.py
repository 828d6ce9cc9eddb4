"""Live metrics over the window metric table (``schemas.METRIC_SCHEMA``).

These replace per-refresh pandas work with Spark plans over the stored metric.  The
KPIs and the latest window's rows come from one pass over it: values per window are
folded first, and the latest window is the maximum of what is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The funnel stages of the clickstream, in order.
DEFAULT_TYPES = ("view", "addtocart", "transaction")


def kpis(metric: DataFrame) -> DataFrame:
    """One row: latest window, events in it (NULL types included, 0 if none),
    all events, distinct non-NULL event types."""
    per = metric.groupingSets([["window_start"], ["event"]], "window_start", "event").agg(
        F.sum("event_count").alias("n"), F.grouping("event").alias("is_window")
    )
    is_window = F.col("is_window") == 1
    latest = F.max(F.when(is_window, F.struct("window_start", "n")))
    return per.agg(
        latest["window_start"].alias("latest_window"),
        F.coalesce(latest["n"], F.lit(0).cast("long")).alias("events_latest"),
        F.coalesce(F.sum(F.when(is_window, F.col("n"))), F.lit(0).cast("long")).alias("total_events"),
        F.count(F.when(~is_window, F.col("event"))).alias("event_types"),
    )


def latest_breakdown(metric: DataFrame) -> DataFrame:
    """Rows of the latest window, largest count first."""
    per_window = metric.groupBy("window_start", "window_end").agg(
        F.collect_list(F.struct("event", "event_count")).alias("rows")
    )
    latest = per_window.filter(F.col("window_start").isNotNull()).agg(
        F.max(F.struct("window_start", "window_end")).alias("w"), F.max_by("rows", "window_start").alias("rows")
    )
    return (
        latest.select("w.window_start", "w.window_end", F.inline("rows"))
        .orderBy(F.desc("event_count"), F.asc_nulls_first("event"))
    )


def event_types(metric: DataFrame, most: int = 1000) -> list[str]:
    """The non-NULL types of the metric, the funnel's stages first, the rest in text
    order.  More than ``most`` are an error: a column each would not be a table.  The one
    function here that runs an action; :func:`last_n_long` and :func:`last_n_maps` do
    without the names."""
    rows = metric.filter(F.col("event").isNotNull()).select("event").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} event types; name the columns wanted")
    found = {r.event for r in rows}
    return [t for t in DEFAULT_TYPES if t in found] + sorted(found - set(DEFAULT_TYPES))


def wide_windows(metric: DataFrame, types: Sequence[str] | None = None, other: str | None = "other") -> DataFrame:
    """Pivot: one row per window, one 0-filled count column per event type.

    With ``types`` given, the counts of all others are in the column ``other`` (none with
    ``other=None``).  ``types`` defaults to all types of the metric, found by an action.
    Types that cannot be columns of one table (names that differ in case only, or are
    ``window_start``) are an error; :func:`last_n_maps` takes any.  Windows whose rows all
    have a NULL type are absent (a NULL type is not a column).  Written as conditional
    aggregation: one aggregation, one shuffle, partial aggregation map-side.
    """
    given = types is not None
    types = list(types) if given else event_types(metric)
    names = [*types, other] if given and other else types
    lowered = ["window_start", *(t.lower() for t in names)]
    if len(set(lowered)) < len(lowered):
        raise ValueError("these types cannot be the columns of one table; use last_n_maps or last_n_long")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("event_count"))), F.lit(0).cast("long"))

    columns = [total(F.col("event") == F.lit(t)).alias(t) for t in types]
    if given and other:
        columns.append(total(~F.col("event").isin(types)).alias(other))
    rows = metric.filter(F.col("event").isNotNull()).groupBy("window_start")
    return rows.agg(*columns) if columns else rows.agg(F.count(F.lit(1)).alias("n")).drop("n")


def last_n_wide(metric: DataFrame, n: int = 60, types: Sequence[str] | None = None, other: str | None = "other") -> DataFrame:
    """The ``n`` latest existing windows of ``wide_windows``, oldest first.
    Missing minutes are not filled in."""
    return wide_windows(metric, types, other).orderBy(F.desc("window_start")).limit(n).orderBy("window_start")


def _folded(metric: DataFrame) -> DataFrame:
    """One row per window and type, neither of them NULL.

    The condition on the count holds always (counts are not negative).  It names the count
    for every reader of these rows, so that Spark makes their shuffle once and reuses it
    instead of computing the metric a second time without the count."""
    rows = metric.filter(F.col("event").isNotNull() & F.col("window_start").isNotNull())
    return rows.groupBy("window_start", "event").agg(F.sum("event_count").alias("event_count")).filter(F.col("event_count") >= 0)


def last_n_long(metric: DataFrame, n: int = 60) -> DataFrame:
    """``window_start, event, event_count`` for the ``n`` latest existing windows and every
    type of the whole metric, zeros kept.

    Types are data here, never column names: any text is a type, in any number and case.
    A type's cells are one map of at most ``n`` entries; the windows, ``n`` at most, are a
    scalar subquery over the same shuffle, and every type is crossed with them by
    ``explode``.  One pass over the metric, no action.  Missing minutes are not filled in,
    windows whose rows all have a NULL type are absent."""
    per = _folded(metric)
    latest = per.select("window_start").distinct().orderBy(F.desc("window_start")).limit(n)
    windows = latest.agg(F.sort_array(F.collect_list("window_start")).alias("windows")).scalar()
    own = F.when(F.array_contains(windows, F.col("window_start")), F.struct("window_start", "event_count"))
    cells = per.groupBy("event").agg(F.map_from_entries(F.collect_list(own)).alias("cells"))
    crossed = cells.select("event", "cells", F.explode(windows).alias("window_start"))
    return crossed.select(
        "window_start", "event", F.coalesce(F.col("cells")[F.col("window_start")], F.lit(0).cast("long")).alias("event_count"))


def last_n_maps(metric: DataFrame, n: int = 60) -> DataFrame:
    """The wide view without a schema made of data: ``window_start`` and ``counts``, a map
    of type to count (zeros kept), for the ``n`` latest windows, oldest first."""
    rows = last_n_long(metric, n).groupBy("window_start")
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("event", "event_count"))).alias("counts")).orderBy("window_start")


def event_totals(metric: DataFrame) -> DataFrame:
    """Sum of counts per non-NULL event type."""
    return (
        metric.filter(F.col("event").isNotNull())
        .groupBy("event")
        .agg(F.sum("event_count").alias("event_count"))
    )
