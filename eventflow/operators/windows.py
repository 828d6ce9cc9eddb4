"""The event-time window metric, one definition for static and streaming input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.time import ms_to_instant


def with_event_ts(df: DataFrame, ms_col: str = "timestamp", out: str = "event_ts") -> DataFrame:
    """Raw rows -> add the full-precision event instant used by the window metric."""
    return df.withColumn(out, ms_to_instant(ms_col))


def events_per_window(
    df: DataFrame,
    time_col: str = "event_ts",
    width: str = "1 minute",
    by: Sequence[str] = ("event",),
    watermark: str | None = None,
) -> DataFrame:
    """Rows per tumbling, epoch-aligned ``[start, end)`` window and ``by`` keys.

    ``watermark`` (e.g. ``"2 minutes"``) bounds the state of a streaming query and
    decides which late rows are dropped; on static input it has no effect.
    Output: ``window_start, window_end, *by, event_count``.
    """
    if watermark:
        df = df.withWatermark(time_col, watermark)
    return (
        df.groupBy(F.window(time_col, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *by,
            "event_count",
        )
    )
