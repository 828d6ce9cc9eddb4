"""Data behind the live and batch views, computed by Spark from the stored results.

The page itself (layout, charts) is out of scope; these are the tables it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.format import percent_label, thousands
from eventflow.operators import funnel as fn
from eventflow.operators import insights as ins
from eventflow.operators import live
from eventflow.plans.batch import load_csv_results, show_all
from eventflow.schemas import METRIC_SCHEMA
from eventflow.sources.files import path_exists, read_events_csv, read_latest_snapshot, read_parquet_result
from eventflow.streaming.snapshots import day_files, read_day_snapshot

COVERAGE_SCHEMA = "min_ts timestamp, max_ts timestamp, n_events long, source string"


def load_stream_metric(spark: SparkSession, folder: str) -> DataFrame:
    """The latest metric snapshot, of either kind, oldest window first; empty if none yet."""
    if day_files(spark, folder):
        return read_day_snapshot(spark, folder).orderBy("window_start")
    return read_latest_snapshot(spark, folder, METRIC_SCHEMA).orderBy("window_start")


def kpi_labels(kpis: DataFrame) -> DataFrame:
    """Display text of the KPI row: ``1,234``-style counts."""
    return kpis.select(
        thousands("events_latest").alias("events_latest"),
        thousands("total_events").alias("total_events"),
        F.col("event_types").cast("string").alias("event_types"),
    )


def funnel_labels(funnel: DataFrame) -> DataFrame:
    """Display text of the funnel rates: ``2.60 %``."""
    return funnel.select(*[percent_label(c).alias(c) for c in fn.DEFAULT_RATE_NAMES])


def load_metric_table(spark: SparkSession, path: str) -> DataFrame:
    """The append-mode metric table (finalised windows only), oldest first.  Its
    state is bounded by the watermark, so this is the source to use on long runs;
    the complete-mode snapshot keeps every window in state for ever."""
    return read_parquet_result(spark, path, METRIC_SCHEMA).orderBy("window_start")


def live_view(metric: DataFrame, last_n: int = 60) -> dict[str, DataFrame]:
    kpis = live.kpis(metric)
    funnel = fn.funnel(live.event_totals(metric), "event_count")
    return {
        "kpis": kpis,
        "kpi_labels": kpi_labels(kpis),
        "funnel_labels": funnel_labels(funnel),
        "last_n_wide": live.last_n_maps(metric, last_n),  # types are data: any name will do
        "last_n_long": live.last_n_long(metric, last_n),
        "latest_breakdown": live.latest_breakdown(metric),
        "funnel": funnel,
    }


def batch_view(spark: SparkSession, csv_dir: str, top_n: int = 20) -> dict[str, DataFrame]:
    res = load_csv_results(spark, csv_dir)
    daily = res["daily_visitors"].orderBy(F.asc_nulls_first("event_date"))
    window = ins.date_window(daily)
    return {
        "date_window": window,
        "date_window_labels": ins.date_window_labels(window),
        "top_items": res["top_items"].orderBy(F.desc("view_count"), F.asc_nulls_first("itemid")).limit(top_n),
        "event_distribution": res["event_distribution"],
        "funnel": fn.funnel(res["event_distribution"], "count"),
        "daily_visitors": daily,
    }


def dataset_coverage(spark: SparkSession, path: str) -> DataFrame:
    """Coverage of a raw events CSV with a status: ``csv``, ``empty``, ``missing``
    (no such path) or ``error: ...`` (unreadable).  Only the ``timestamp`` column is
    read (the CSV scan is pruned to it).  The one-row aggregate is evaluated here so
    that a read error becomes a status instead of failing a later action."""
    if not path_exists(spark, path):
        return spark.createDataFrame([(None, None, 0, "missing")], COVERAGE_SCHEMA)
    try:
        cov = ins.coverage(read_events_csv(spark, path).select("timestamp"), source="csv")
        return spark.createDataFrame(cov.collect(), COVERAGE_SCHEMA)
    except Exception as exc:  # unreadable input is a status, not a crash of the view
        return spark.createDataFrame([(None, None, 0, f"error: {type(exc).__name__}: {str(exc).strip().splitlines()[0] if str(exc).strip() else ''}")], COVERAGE_SCHEMA)


def main(argv: list[str] | None = None) -> None:
    """Print the dashboard's tables:
    ``python -m eventflow.plans.dashboard --stream /results/stream/snapshot/events_per_minute
    --batch /results/batch --events /data/events.csv``"""
    import argparse

    from eventflow.session import build_spark

    ap = argparse.ArgumentParser(description="dashboard tables as text")
    ap.add_argument("--stream", help="metric snapshot folder written by the streaming job")
    ap.add_argument("--metric-table", help="append-mode metric table (finalised windows) instead of the snapshot")
    ap.add_argument("--batch", help="CSV result folder written by the batch job")
    ap.add_argument("--events", help="raw events CSV, for the coverage line")
    ap.add_argument("--last-n", type=int, default=60)
    args = ap.parse_args(argv)
    spark = build_spark("eventflow-dashboard")
    if args.events:
        cov = dataset_coverage(spark, args.events)
        cov.show(truncate=False)
        ins.coverage_labels(cov).show(truncate=False)
    if args.stream or args.metric_table:
        metric = load_metric_table(spark, args.metric_table) if args.metric_table else load_stream_metric(spark, args.stream)
        for name, df in live_view(metric, args.last_n).items():
            print(f"== live: {name}")
            show_all(df)
    if args.batch:
        for name, df in batch_view(spark, args.batch).items():
            print(f"== batch: {name}")
            show_all(df)


if __name__ == "__main__":
    main()
