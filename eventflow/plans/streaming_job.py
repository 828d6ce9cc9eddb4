"""The streaming job: envelopes (Kafka or replay files) -> window metric and raw
archive sinks, each query with its own checkpoint.

    python -m eventflow.plans.streaming_job --out /shared/stream --checkpoints /shared/ckpt \\
        --kafka kafka:9092 --topic events
    python -m eventflow.plans.streaming_job --out ... --checkpoints ... --envelopes /shared/replay --available-now
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from eventflow.session import build_spark
from eventflow.streaming.queries import (
    DEFAULT_TRIGGERS,
    metric_stream,
    read_landed_stream,
    start_console,
    start_landing,
    start_metric_append,
    start_metric_snapshot,
)
from eventflow.streaming.snapshots import start_day_snapshot
from eventflow.streaming.sources import read_envelope_stream, read_kafka_stream, read_message_files

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sink_paths(out_dir: str, console: bool = False, snapshot: bool = False, day_snapshot: bool = False) -> dict[str, str]:
    """The default sinks: ``landing`` (archive and quarantine, one parse) and ``metric``
    (finalised windows, bounded state).  On request: ``day_snapshot``, the CSV snapshot
    with open windows, of which a trigger rewrites the changed days; ``snapshot``, the
    complete-mode one, which keeps every window in state for ever."""
    base = out_dir.rstrip("/")
    paths = {"landing": f"{base}/raw-events", "metric": f"{base}/events_per_minute"}
    if snapshot:
        paths["snapshot"] = f"{base}/snapshot/events_per_minute"
    if day_snapshot:
        paths["day_snapshot"] = f"{base}/day-snapshot/events_per_minute"
    if console:
        paths["console"] = "-"
    return paths


def run_streaming_job(spark: SparkSession, envelopes: DataFrame, out_dir: str, checkpoints: str,
                      available_now: bool = False, console: bool = False, snapshot: bool = False,
                      wait: bool = True, timeout_s: float | None = None, state_partitions: int | None = None,
                      archive_by_date: bool = False, day_snapshot: bool = False):
    """Land the envelopes once and start the other sinks on what has landed; with
    ``wait``, block until any query ends (the job's life ends with its first failing
    query; restart resumes from the checkpoints).  ``available_now`` processes the
    backlog sink after sink and always waits.  A wait longer than ``timeout_s`` is an
    error; the queries go on."""
    triggers = {k: ("availableNow" if available_now else v) for k, v in DEFAULT_TRIGGERS.items()}
    paths = sink_paths(out_dir, console, snapshot, day_snapshot)
    base = checkpoints.rstrip("/")
    spark.streams.resetTerminated()  # the wait is for this job's queries, not for earlier ones
    queries = {"landing": start_landing(envelopes, paths["landing"], f"{base}/landing", triggers["landing"], archive_by_date)}
    if available_now:
        _await(queries["landing"], timeout_s)
    metric = metric_stream(read_landed_stream(spark, paths["landing"]))
    starters = {"metric": start_metric_append, "snapshot": start_metric_snapshot, "day_snapshot": start_day_snapshot,
                "console": lambda m, _, c, t, state_partitions: start_console(m, c, t, state_partitions=state_partitions)}
    for sink in [s for s in paths if s != "landing"]:
        queries[sink] = starters[sink](metric, paths[sink], f"{base}/{sink}", triggers[sink], state_partitions=state_partitions)
        if available_now:
            _await(queries[sink], timeout_s)
    if wait and not available_now and not spark.streams.awaitAnyTermination(timeout_s) and timeout_s is not None:
        raise TimeoutError(f"no query ended within {timeout_s} s")
    return queries


def _await(query, timeout_s: float | None) -> None:
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        raise TimeoutError(f"query {query.name or query.id} did not finish within {timeout_s} s")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoints", required=True)
    ap.add_argument("--kafka")
    ap.add_argument("--topic", default="events")
    ap.add_argument("--envelopes", help="folder of envelope parquet files instead of Kafka")
    ap.add_argument("--messages", help="folder of JSON-lines message files instead of Kafka")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--snapshot", action="store_true", help="also rewrite the whole metric as CSV (complete mode, unbounded state)")
    ap.add_argument("--day-snapshot", action="store_true", help="also keep the metric as CSV by days; a trigger rewrites the days it changed")
    ap.add_argument("--rocksdb", action="store_true", help="RocksDB state store for large state")
    ap.add_argument("--archive-by-date", action="store_true", help="partition the raw archive by UTC event date")
    ap.add_argument("--state-partitions", type=int, help="state partitions of the metric queries (fixed at first start)")
    ap.add_argument("--max-offsets-per-trigger", type=int, help="bound each Kafka micro-batch")
    ap.add_argument("--min-partitions", type=int, help="split large Kafka partitions over more tasks")
    ap.add_argument("--max-files-per-trigger", type=int,
                    help="bound each replay micro-batch (--envelopes); files are taken in modification-time "
                         "order, so use it only for replays written one time slice at a time, or rows of a "
                         "later file may fall behind the watermark")
    args = ap.parse_args(argv)
    conf = {}
    if args.rocksdb:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    spark = build_spark("eventflow-streaming", **conf)
    if args.envelopes:
        envelopes = read_envelope_stream(spark, args.envelopes, args.max_files_per_trigger)
    elif args.messages:
        envelopes = read_message_files(spark, args.messages, max_files_per_trigger=args.max_files_per_trigger)
    elif args.kafka:
        extra = {}
        if args.max_offsets_per_trigger:
            extra["maxOffsetsPerTrigger"] = args.max_offsets_per_trigger
        if args.min_partitions:
            extra["minPartitions"] = args.min_partitions
        envelopes = read_kafka_stream(spark, args.kafka, args.topic, **extra)
    else:
        ap.error("give --kafka, --envelopes or --messages")
    run_streaming_job(spark, envelopes, args.out, args.checkpoints, args.available_now, args.console, args.snapshot,
                      state_partitions=args.state_partitions, archive_by_date=args.archive_by_date, day_snapshot=args.day_snapshot)


if __name__ == "__main__":
    main()
