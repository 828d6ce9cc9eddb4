"""The batch job: raw clickstream -> three insights -> parquet and CSV.

Cost shape: two passes over the raw rows.  One counts rows per event type and item
(stored once in the shared scratch folder); the top items, the distribution and the
total follow from that small table.  The other is the exact distinct of visitors per
day.  The input is never copied unless the caller asks for it (``stage_csv=True``,
worth it when more jobs will read the same CSV).  Results are written to the shared
output folder, so a lost executor costs a re-read of a finished file.

A run writes into a folder of its own and is published by one commit
(``sinks.publish``): readers see all results of one run, parquet and CSV alike, and a run
that fails half-way leaves the published ones as they are.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.operators import insights as ins
from eventflow.schemas import RESULT_SCHEMAS
from eventflow.session import build_spark, scratch_path
from eventflow.sinks.files import write_csv, write_parquet
from eventflow.sinks.publish import commit_run, new_run, results_folder, run_folder
from eventflow.sources.files import (
    delete_path,
    read_archive,
    read_events_csv,
    read_parquet_result,
    read_result_folder,
    resolve_input,
)

RESULT_NAMES = ("top_items", "event_distribution", "daily_visitors")
# order of the rows in each stored result
RESULT_ORDER = {
    "top_items": lambda: (F.desc("view_count"), F.asc_nulls_first("itemid")),
    "event_distribution": lambda: (F.desc("count"), F.asc_nulls_first("event")),
    "daily_visitors": lambda: (F.asc_nulls_first("event_date"),),
}


@dataclass
class BatchResult:
    input_path: str
    parquet_dir: str
    csv_dir: str | None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    run: str = ""

    def total_events(self) -> DataFrame:
        """All input rows, from the stored distribution (no second pass over raw)."""
        return self.tables["event_distribution"].agg(
            F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_events")
        )


def stage_raw(spark: SparkSession, raw: DataFrame, path: str | None = None) -> DataFrame:
    """Write the raw rows once as parquet (shared scratch folder) and read them back."""
    path = path or scratch_path(spark, "staged-raw")
    write_parquet(raw, path)
    return spark.read.parquet(path)


def run_batch_job(
    spark: SparkSession,
    inputs: list[str] | str,
    parquet_dir: str,
    csv_dir: str | None = None,
    input_format: str | None = None,
    stage_csv: bool = False,
    top_n: int = 20,
    staged_path: str | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
    keep_runs: int = 2,
    on_stored: Callable[[str], None] | None = None,
) -> BatchResult:
    """Resolve the input, compute the insights once, write parquet (and a one-file
    CSV per result, for small consumers), publish them together, and return the stored
    results.  Read them with :func:`load_csv_results` or :func:`load_parquet_results`.

    ``keep_runs`` published runs are kept, for readers that are still at the one before.
    ``on_stored`` is called with each result's name once it is written; an error raised
    there fails the run like any other.

    ``stage_csv`` copies a CSV input to parquet first; ``staged_path`` keeps the copy at
    a chosen place (default: scratch).
    ``input_format="archive"`` replays the streaming job's raw archive, optionally
    only the days ``first_day`` .. ``last_day`` (pruned on its date partitions)."""
    candidates = [inputs] if isinstance(inputs, str) else list(inputs)
    own_copy = None
    path = resolve_input(spark, candidates)
    fmt = input_format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "csv":
        raw = read_events_csv(spark, path)
        if stage_csv:
            own_copy = None if staged_path else scratch_path(spark, "staged-raw")
            raw = stage_raw(spark, raw, staged_path or own_copy)
    elif fmt == "archive":
        raw = read_archive(spark, path, first_day, last_day)
    else:
        raw = spark.read.parquet(path)
    run = new_run()
    result = BatchResult(path, parquet_dir, csv_dir, run=run)
    places = {"parquet": parquet_dir} | ({"csv": csv_dir} if csv_dir else {})

    counts_path = scratch_path(spark, "item-event-counts")

    def item_counts() -> DataFrame:
        write_parquet(ins.item_event_counts(raw), counts_path)
        return spark.read.parquet(counts_path)

    def materialise(name: str, df: DataFrame) -> DataFrame:
        target = f"{run_folder(parquet_dir, run)}/{name}"
        write_parquet(df, target)
        stored = read_parquet_result(spark, target, RESULT_SCHEMAS[name])
        if csv_dir:
            # top-n and one row per day are bounded: one file each; event types are not
            write_csv(stored, f"{run_folder(csv_dir, run)}/{name}", single_file=name != "event_distribution",
                      order_by=RESULT_ORDER[name]())
        if on_stored:
            on_stored(name)
        return stored

    # The two passes are independent jobs: submitted from two threads they share the
    # cluster, and one job's last tasks do not leave the other's slots idle.
    try:
        with ThreadPoolExecutor(max_workers=2) as pool:
            daily = pool.submit(materialise, "daily_visitors", ins.daily_visitors(raw))
            counts = pool.submit(item_counts).result()
            result.tables["top_items"] = materialise("top_items", ins.top_items_from_counts(counts, top_n))
            result.tables["event_distribution"] = materialise("event_distribution", ins.event_distribution_from_counts(counts))
            result.tables["daily_visitors"] = daily.result()
        commit_run(spark, parquet_dir, run, places, keep_runs)
    except BaseException:
        for base in places.values():  # a killed run cannot do this: see publish.drop_unpublished
            delete_path(spark, run_folder(base, run))
        raise
    finally:
        for path in filter(None, (counts_path, own_copy)):  # the results do not read them
            delete_path(spark, path)
    return result


def load_parquet_results(spark: SparkSession, parquet_dir: str) -> dict[str, DataFrame]:
    """The published parquet results, all of one run."""
    base = results_folder(spark, parquet_dir)
    return {name: read_parquet_result(spark, f"{base}/{name}", RESULT_SCHEMAS[name]) for name in RESULT_NAMES}


def load_csv_results(spark: SparkSession, csv_dir: str) -> dict[str, DataFrame]:
    """Read the three published CSV results back, typed, all of one run."""
    base = results_folder(spark, csv_dir)
    return {
        name: read_result_folder(spark, f"{base}/{name}", RESULT_SCHEMAS[name]) for name in RESULT_NAMES
    }


def preview(result: BatchResult, n: int = 20) -> None:
    """Console preview of the top items and the distribution."""
    result.tables["top_items"].orderBy(F.desc("view_count"), F.asc_nulls_first("itemid")).show(n, truncate=False)
    show_all(result.tables["event_distribution"].orderBy(*RESULT_ORDER["event_distribution"]()))


def show_all(df: DataFrame) -> None:
    """Print every row of a small result."""
    df.show(max(df.count(), 1), truncate=False)


def main(argv: list[str] | None = None) -> None:
    """``python -m eventflow.plans.batch --input hdfs:///raw/events.csv --input /data/events.csv
    --parquet-out hdfs:///batch-results --csv-out /results/batch``"""
    ap = argparse.ArgumentParser(description="eventflow batch job")
    ap.add_argument("--input", action="append", required=True, help="candidate input paths, first existing wins")
    ap.add_argument("--parquet-out", required=True)
    ap.add_argument("--csv-out")
    ap.add_argument("--format", choices=["csv", "parquet", "archive"])
    ap.add_argument("--first-day", help="with --format archive: first UTC day (YYYY-MM-DD)")
    ap.add_argument("--last-day", help="with --format archive: last UTC day (YYYY-MM-DD)")
    ap.add_argument("--top-n", type=int, default=20)
    ap.add_argument("--stage", action="store_true", help="copy a CSV input to parquet first")
    args = ap.parse_args(argv)
    spark = build_spark("eventflow-batch")
    res = run_batch_job(spark, args.input, args.parquet_out, args.csv_out, args.format, args.stage, args.top_n,
                        first_day=args.first_day, last_day=args.last_day)
    print(f"input: {res.input_path}; total events: {res.total_events().first().total_events:,}")
    preview(res, args.top_n)


if __name__ == "__main__":
    main()
