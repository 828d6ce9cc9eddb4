"""The metric as a CSV snapshot that grows by days.

A complete-mode snapshot keeps every window in state for ever and rewrites all history at
each trigger.  Here the query runs in update mode, so state is bounded by the watermark,
and each batch rewrites only the days it changed:

    <folder>/day=2015-06-02/batch=17/part-*.csv     the day as of batch 17
    <folder>/_commits/000000000017                  batches up to 17 are whole

Readers take each day's newest version that is not above the newest commit, so they never
see a batch in part.  A repeated batch rewrites its own versions from those of the batches
before it.  Within a day the rows are range-partitioned, newest window first, so the order
of the file names is the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow.functions.time import utc_date
from eventflow.schemas import METRIC_SCHEMA
from eventflow.sinks.files import write_parquet
from eventflow.sources.files import create_text, delete_path, list_children, read_result_files
from eventflow.streaming.control import BatchWriter, start_batches
from eventflow.streaming.queries import refuse_foreign_folder

COMMITS, CHANGES = "_commits", "_changes"
# Text as it is: quotes doubled, blanks and line ends kept, NULL told from an empty text.
NULL_TEXT = "\\N"
CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": NULL_TEXT}
CSV_READ = {"escape": '"', "multiLine": True, "nullValue": NULL_TEXT}


def last_commit(spark: SparkSession, folder: str) -> int | None:
    numbers = [int(n) for n, is_dir in list_children(spark, f"{folder.rstrip('/')}/{COMMITS}") if not is_dir and n.isdigit()]
    return max(numbers, default=None)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Versions of a day, oldest first."""
    return sorted(int(n[6:]) for n, is_dir in list_children(spark, folder) if is_dir and n.startswith("batch=") and n[6:].isdigit())


def day_files(spark: SparkSession, folder: str, days: list[str] | None = None, below: int | None = None) -> list[str]:
    """Folder of each day's committed version (of the given days; of batches before
    ``below``), newest day first."""
    base, done = folder.rstrip("/"), last_commit(spark, folder)
    if done is None:
        return []
    limit = done if below is None else min(done, below - 1)
    if days is None:
        days = [n[4:] for n, is_dir in list_children(spark, base) if is_dir and n.startswith("day=")]
    found = []
    for day in sorted(days, reverse=True):
        versions = [v for v in _numbers(spark, f"{base}/day={day}") if v <= limit]
        if versions:
            found.append(f"{base}/day={day}/batch={versions[-1]}")
    return found


def read_day_snapshot(spark: SparkSession, folder: str, first_day: date | str | None = None, last_day: date | str | None = None) -> DataFrame:
    """The committed snapshot, or some days of it (inclusive); other days' files are not
    opened.  Empty if nothing was committed."""
    files = [f for f in day_files(spark, folder)
             if (first_day is None or f"day={first_day}" <= f.split("/")[-2]) and (last_day is None or f.split("/")[-2] <= f"day={last_day}")]
    return read_result_files(spark, files, METRIC_SCHEMA, **CSV_READ)


def day_snapshot_writer(folder: str, keep: int = 2) -> BatchWriter:
    """``foreachBatch`` function of an update-mode metric.  ``keep`` versions of a changed
    day stay, the older for readers that are still at them."""
    base = folder.rstrip("/")
    staged_schema = T.StructType([*METRIC_SCHEMA.fields, T.StructField("day", T.StringType(), True)])

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        staged = f"{base}/{CHANGES}/batch={batch_id}"
        # the stateful plan runs here, once; what follows reads the few changed rows
        write_parquet(batch_df.select(*METRIC_SCHEMA.names).withColumn("day", utc_date("window_start").cast("string")), staged)
        changes = spark.read.schema(staged_schema).parquet(staged)
        days = [r.day for r in changes.select("day").distinct().collect()]  # a row for each day touched
        if days:
            before = read_result_files(spark, day_files(spark, base, days, below=batch_id), METRIC_SCHEMA, **CSV_READ)
            rows = before.withColumn("age", F.lit(0)).unionByName(changes.drop("day").withColumn("age", F.lit(1)))
            merged = rows.groupBy("window_start", "window_end", "event").agg(F.max_by("event_count", "age").alias("event_count"))
            placed = merged.withColumn("day", utc_date("window_start").cast("string")).withColumn("batch", F.lit(batch_id))
            order = (F.desc("window_start"), F.asc_nulls_first("event"))
            (placed.repartitionByRange(*order).sortWithinPartitions(F.desc("day"), *order)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**CSV_WRITE)
             .partitionBy("day", "batch").csv(base))
        create_text(spark, f"{base}/{COMMITS}/{batch_id:012d}", "", overwrite=True)
        delete_path(spark, staged)
        for day in days:
            for version in _numbers(spark, f"{base}/day={day}")[:-keep]:
                delete_path(spark, f"{base}/day={day}/batch={version}")
        for name, _ in list_children(spark, f"{base}/{COMMITS}"):
            if name.isdigit() and int(name) < batch_id - 1:
                delete_path(spark, f"{base}/{COMMITS}/{name}")

    return write


def start_day_snapshot(metric: DataFrame, folder: str, checkpoint: str, trigger: str | None = "15 seconds", name: str | None = None,
                       keep: int = 2, state_partitions: int | None = None,
                       wrap: Callable[[BatchWriter], BatchWriter] | None = None) -> StreamingQuery:
    """Keep the metric's snapshot in ``folder`` by days.  Late rows are dropped, as state of
    finished windows is.  ``wrap`` puts the writer under control (``streaming.control``)."""
    refuse_foreign_folder(metric.sparkSession, folder, checkpoint, "day=")
    write = day_snapshot_writer(folder, max(keep, 2))
    return start_batches(metric, wrap(write) if wrap else write, checkpoint, trigger, "update", name, state_partitions)
