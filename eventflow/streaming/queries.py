"""Streaming queries of the pipeline: metric (append / complete snapshot / update
log / console), raw archive, quarantine and Kafka publishing.

Every query has its own checkpoint, so a restart resumes from its committed
offsets and state.  Errors are not swallowed: a failing sink fails its query and
the micro-batch is retried on restart (opt-in tolerance only at start-up, see
:func:`start_all`).
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow.functions.messages import decode_envelopes, malformed_records, parse_envelopes, with_event_ts
from eventflow.functions.time import utc_date
from eventflow.operators.windows import events_per_window
from eventflow.schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA, METRIC_SCHEMA
from eventflow.sinks.files import write_versioned_snapshot
from eventflow.sinks.kafka import kafka_sink_options
from eventflow.sources.files import list_children, make_folder

# Trigger interval per sink.
DEFAULT_TRIGGERS = {
    "console": "20 seconds",
    "snapshot": "15 seconds",
    "day_snapshot": "15 seconds",
    "metric": "30 seconds",
    "archive": "30 seconds",
    "quarantine": "30 seconds",
    "landing": "30 seconds",
    "updates": "20 seconds",
}


# Spark's default, spelled out: a writer's trigger() takes no empty setting.
BACK_TO_BACK = {"processingTime": "0 seconds"}


@contextmanager
def state_partitions_for_start(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Start a stateful query with ``n`` state partitions.  The number is read from
    the session when the query starts and then kept in its checkpoint for good (a
    restart reuses it), so the session setting is changed only around ``start()``."""
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def trigger_kwargs(trigger: str | None) -> dict:
    """``"availableNow"`` / ``"once"`` / a processing interval such as
    ``"15 seconds"``; ``None`` runs micro-batches back to back.  (Continuous
    processing does not support the window aggregation, so it is not offered.)"""
    if trigger is None:
        return {}
    if trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def metric_stream(parsed: DataFrame, width: str = "1 minute", watermark: str = "2 minutes") -> DataFrame:
    """Events per window and type with a watermark on ``event_ts``."""
    return events_per_window(parsed, "event_ts", width, ("event",), watermark=watermark)


def _start(w, spark: SparkSession, name: str | None, state_partitions: int | None) -> StreamingQuery:
    with state_partitions_for_start(spark, state_partitions):
        return w.start(queryName=name) if name else w.start()


def start_metric_append(metric: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds",
                        name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Finalised windows (end <= watermark) appended to parquet, once each.
    State of a window is dropped when it is emitted, so state stays bounded."""
    w = (metric.writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)))
    return _start(w, metric.sparkSession, name, state_partitions)


def refuse_foreign_folder(spark: SparkSession, folder: str, checkpoint: str, prefix: str) -> None:
    """Versions in ``folder`` are numbered by the batches of one checkpoint.  A new
    checkpoint starts at 0 again, so beside older versions its results would be taken
    for outdated ones; starting there is an error."""
    has_versions = any(name.startswith(prefix) for name, _ in list_children(spark, folder))
    if has_versions and not list_children(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{folder} holds versions of another checkpoint; give {checkpoint} a folder of its own")


def snapshot_writer(folder: str, order_col: str = "window_start", keep: int = 2,
                    single_file: bool = False) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing the whole result table of each micro-batch as a
    versioned CSV snapshot, newest window first within each file (one file, and so
    a total order, with ``single_file``; sorting within partitions needs no shuffle).

    The write is the only action on the batch: the row count is observed during the
    write (``DataFrame.observe``), so the stateful plan runs once without being
    cached.  ``rows_written`` keeps ``(batch_id, rows)`` of the last batches."""
    rows_written: deque[tuple[int, int]] = deque(maxlen=100)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        seen = Observation(f"snapshot_{batch_id}")
        out = batch_df.observe(seen, F.count(F.lit(1)).alias("rows"))
        out = out.coalesce(1) if single_file else out
        write_versioned_snapshot(out.sortWithinPartitions(F.col(order_col).desc()), folder, batch_id, keep)
        rows_written.append((batch_id, int(seen.get["rows"])))

    write.rows_written = rows_written  # type: ignore[attr-defined]
    return write


def start_metric_snapshot(metric: DataFrame, folder: str, checkpoint: str, trigger: str | None = "15 seconds",
                          name: str | None = None, keep: int = 2, single_file: bool = False,
                          state_partitions: int | None = None) -> StreamingQuery:
    """Complete mode: the full metric table rewritten as a snapshot each batch.
    Complete mode keeps every window in state for ever and counts late rows; for
    long runs prefer :func:`start_metric_append` and read the appended table."""
    refuse_foreign_folder(metric.sparkSession, folder, checkpoint, "batch=")
    w = (metric.writeStream.outputMode("complete")
         .foreachBatch(snapshot_writer(folder, keep=keep, single_file=single_file))
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)))
    return _start(w, metric.sparkSession, name, state_partitions)


def update_log_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function appending each batch's updated rows with its batch id.
    Idempotent per batch: a retried batch overwrites its own partition only."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        (batch_df.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))

    return write


def start_metric_updates(metric: DataFrame, path: str, checkpoint: str, trigger: str | None = "20 seconds",
                         name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Update mode: rows whose count changed in a batch, logged with the batch id."""
    refuse_foreign_folder(metric.sparkSession, path, checkpoint, "batch_id=")
    w = (metric.writeStream.outputMode("update")
         .foreachBatch(update_log_writer(path))
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)))
    return _start(w, metric.sparkSession, name, state_partitions)


def latest_updates(spark: SparkSession, path: str) -> DataFrame:
    """Current value per window and type from an update log: the row of the last
    batch that touched the key (a partial aggregate, no per-key sort)."""
    schema = T.StructType(METRIC_SCHEMA.fields + [T.StructField("batch_id", T.LongType(), True)])
    log = spark.read.schema(schema).parquet(path)
    return log.groupBy("window_start", "window_end", "event").agg(
        F.max_by("event_count", "batch_id").alias("event_count")
    )


def start_console(metric: DataFrame, checkpoint: str, trigger: str | None = "20 seconds",
                  num_rows: int = 20, state_partitions: int | None = None) -> StreamingQuery:
    w = (metric.writeStream.outputMode("update").format("console")
         .option("truncate", "false").option("numRows", num_rows)
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)))
    return _start(w, metric.sparkSession, None, state_partitions)


def start_archive(parsed: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds",
                  partition_by_date: bool = False, name: str | None = None) -> StreamingQuery:
    """Raw archive: the 7 message fields appended as parquet.  With
    ``partition_by_date`` the files go to ``event_date=`` folders (UTC date of the
    event time, or of the broker time when the message has none) so replays of a
    date range prune the rest."""
    out = parsed.select(*MESSAGE_COLUMNS, "event_ts")
    if partition_by_date:
        out = out.withColumn("event_date", utc_date("event_ts"))
    out = out.drop("event_ts")
    w = out.writeStream.outputMode("append").format("parquet")
    if partition_by_date:
        w = w.partitionBy("event_date")
    w = w.option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK))
    return w.start(queryName=name) if name else w.start()


def start_quarantine(raw: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds") -> StreamingQuery:
    """Records with no readable field, kept as text with their broker time."""
    return (malformed_records(raw).writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)).start())


LANDED_SCHEMA = T.StructType(
    [f for f in MESSAGE_SCHEMA.fields]
    + [T.StructField(n, T.TimestampType(), True) for n in ("kafka_ts", "event_ts")]
    + [T.StructField("json_str", T.StringType(), True), T.StructField("kind", T.StringType(), True)]
)


def start_landing(raw: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds",
                  partition_by_date: bool = False) -> StreamingQuery:
    """One parse for everything behind it: messages go to ``kind=event`` (the raw
    archive), records with no readable field to ``kind=junk`` (the quarantine, with
    their text); with ``partition_by_date`` further by UTC event date.  Other queries
    read the parsed columns from here (:func:`read_landed_stream`)."""
    decoded = with_event_ts(decode_envelopes(raw))
    out = decoded.select(
        *MESSAGE_COLUMNS, "kafka_ts", "event_ts",
        F.when(F.col("malformed"), F.col("json_str")).alias("json_str"),
        F.when(F.col("malformed"), F.lit("junk")).otherwise(F.lit("event")).alias("kind"),
    )
    by = ["kind"]
    if partition_by_date:
        out = out.withColumn("event_date", utc_date("event_ts"))
        by.append("event_date")
    return (out.writeStream.outputMode("append").format("parquet").partitionBy(*by)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)).start())


def read_landed_stream(spark: SparkSession, path: str) -> DataFrame:
    """The messages of :func:`start_landing` as a stream; only the columns a query uses
    are read, and nothing is parsed again."""
    make_folder(spark, path)  # the landing query may not have written yet
    rows = spark.readStream.schema(LANDED_SCHEMA).parquet(path)
    return rows.filter(F.col("kind") == "event").select(*MESSAGE_COLUMNS, "kafka_ts", "event_ts")


def start_kafka_publish(envelopes: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                        trigger: str | None = None, **options: str) -> StreamingQuery:
    """Publish a stream of envelopes to Kafka (needs ``spark-sql-kafka-0-10``)."""
    return (envelopes.select("key", "value").writeStream.format("kafka")
            .options(**kafka_sink_options(bootstrap, topic, **options))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)).start())


def start_all(raw: DataFrame, out: dict[str, str], checkpoints: str, triggers: dict[str, str | None] | None = None,
              on_malformed: str = "quarantine", tolerate_start_failures: bool = False,
              width: str = "1 minute", watermark: str = "2 minutes",
              state_partitions: int | None = None,
              archive_by_date: bool = False) -> dict[str, StreamingQuery | Exception]:
    """Fan one envelope stream out to the sinks named in ``out``:
    ``metric`` (append parquet), ``snapshot`` (complete CSV), ``updates`` (update
    log), ``archive`` (raw parquet), ``quarantine``, ``console`` (any value).
    Each query re-reads the source with its own checkpoint under ``checkpoints``.
    ``triggers`` overrides :data:`DEFAULT_TRIGGERS` per sink (``"availableNow"``
    processes the backlog and stops).  With ``tolerate_start_failures`` a sink that
    cannot start is reported in the result instead of raising."""
    triggers = {**DEFAULT_TRIGGERS, **(triggers or {})}
    parsed = parse_envelopes(raw, on_malformed)
    metric = metric_stream(parsed, width, watermark)
    starters = {
        "metric": lambda p, c, t: start_metric_append(metric, p, c, t, state_partitions=state_partitions),
        "snapshot": lambda p, c, t: start_metric_snapshot(metric, p, c, t, state_partitions=state_partitions),
        "updates": lambda p, c, t: start_metric_updates(metric, p, c, t, state_partitions=state_partitions),
        "archive": lambda p, c, t: start_archive(parsed, p, c, t, partition_by_date=archive_by_date),
        "quarantine": lambda p, c, t: start_quarantine(raw, p, c, t),
        "console": lambda p, c, t: start_console(metric, c, t, state_partitions=state_partitions),
    }
    started: dict[str, StreamingQuery | Exception] = {}
    for sink, target in out.items():
        if sink not in starters:
            raise ValueError(f"unknown sink {sink!r}")
        try:
            started[sink] = starters[sink](target, f"{checkpoints.rstrip('/')}/{sink}", triggers[sink])
        except Exception as exc:
            if not tolerate_start_failures:
                for q in started.values():
                    if isinstance(q, StreamingQuery):
                        q.stop()
                raise
            started[sink] = exc
    return started


def stop_gracefully(queries: dict | list, timeout_s: float = 60.0, poll_s: float = 0.2) -> None:
    """Stop queries between micro-batches: wait (up to ``timeout_s``) until no
    trigger is running, then stop.  The DStreams-era graceful-shutdown setting does
    not apply to Structured Streaming; a batch cut short is replayed from the
    checkpoint anyway, this only avoids the replay."""
    items = queries.values() if isinstance(queries, dict) else queries
    for q in items:
        if not isinstance(q, StreamingQuery):
            continue
        deadline = time.monotonic() + timeout_s
        while q.isActive and q.status.get("isTriggerActive") and time.monotonic() < deadline:
            time.sleep(poll_s)
        q.stop()
