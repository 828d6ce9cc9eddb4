"""The producer's data work as Spark jobs: raw CSV rows -> normalised JSON
messages keyed by visitor -> Kafka, or -> envelope files for broker-free replays.

The live-traffic simulation (sleep-paced, endless re-reading of the file) is not
rebuilt; a paced feed is a time-sliced replay (``replay_csv_to_files(slices=N)``)
read with ``maxFilesPerTrigger`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.messages import message_json, normalize_rows, to_envelope
from eventflow.functions.time import ms_to_instant
from eventflow.schemas import CORRUPT_COLUMN, ENVELOPE_SCHEMA, RAW_TEXT_SCHEMA
from eventflow.session import scratch_path
from eventflow.sinks.files import write_parquet
from eventflow.sinks.kafka import write_kafka
from eventflow.sources.files import delete_path, list_children, path_exists, read_events_csv
from eventflow.streaming.outbox import start_publish


def read_events_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV with every column as text, as the producer reads it: an empty field is
    ``""``, a field that a short row lacks is NULL.

    Spark's reader gives NULL for both.  Rows of the wrong length are told by the
    corrupt-record column; such a row has as many fields as it has commas outside
    quotes, and one more."""
    return _fields_as_written(_text_reader(spark.read).csv(path))


def read_events_text_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """:func:`read_events_text` for every CSV file dropped into ``folder``."""
    reader = _text_reader(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _fields_as_written(reader.csv(folder))


def _text_reader(reader):
    schema = T.StructType(RAW_TEXT_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    return (reader.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).schema(schema))


def _fields_as_written(rows: DataFrame) -> DataFrame:
    unquoted = F.regexp_replace(CORRUPT_COLUMN, '"[^"]*"', "")
    fields = F.coalesce(F.size(F.split(unquoted, ",", -1)), F.lit(len(RAW_TEXT_SCHEMA.fields)))
    fields = F.when(F.col(CORRUPT_COLUMN).isNull(), F.lit(len(RAW_TEXT_SCHEMA.fields))).otherwise(fields)
    return rows.select(*[
        F.when(F.col(f.name).isNull() & (fields > i), F.lit("")).otherwise(F.col(f.name)).alias(f.name)
        for i, f in enumerate(RAW_TEXT_SCHEMA.fields)
    ])


def split_defaulted(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with a time of their own, messages stamped with the current time
    because theirs was unreadable).  The latter must not reach a watermark: one of them
    among old rows would make all the others late."""
    return messages.filter(~F.col("ts_defaulted")), messages.filter("ts_defaulted")


def csv_to_envelopes(spark: SparkSession, path: str, rejected: str | None = None) -> DataFrame:
    """CSV rows -> ``(key, value, timestamp)`` records, ingest time = now.  Rows without
    a readable timestamp are written to ``rejected`` (JSON text; default: a new scratch
    folder) instead."""
    good, bad = split_defaulted(normalize_rows(read_events_text(spark, path)))
    write_rejected(spark, bad, rejected)
    return to_envelope(good)


def write_rejected(spark: SparkSession, messages: DataFrame, path: str | None) -> None:
    messages.select(message_json(messages).alias("value")).write.mode("append").text(path or scratch_path(spark, "rejected"))


def publish_csv(spark: SparkSession, path: str, bootstrap: str, topic: str, rejected: str | None = None, **kafka_options: str) -> None:
    """Publish a whole CSV file to a Kafka topic in one distributed batch job."""
    write_kafka(csv_to_envelopes(spark, path, rejected), bootstrap, topic, **kafka_options)


def replay_csv_to_files(spark: SparkSession, path: str, out: str, slices: int | None = None, files_per_slice: int = 1) -> None:
    """Write a CSV file as envelope parquet, stamped with each row's event time as
    broker time, for a file-source replay (``streaming.sources.read_envelope_stream``).
    Rows without a readable timestamp go to ``<out>/_rejected`` (hidden from readers).

    With ``slices`` the rows are cut into that many ranges of event time, staged in one
    job, and appended to ``out`` range by range (:func:`append_slices`)."""
    rows = read_events_csv(spark, path)
    messages = normalize_rows(rows, ingest_time=ms_to_instant("timestamp"))
    good, bad = split_defaulted(messages)
    write_rejected(spark, bad, f"{out.rstrip('/')}/_rejected")
    envelopes = to_envelope(good, broker_time=ms_to_instant("timestamp"))
    if not slices:
        write_parquet(envelopes, out, mode="append")
        return
    bounds = good.approxQuantile("timestamp", [i / slices for i in range(1, slices)], 0.001) if slices > 1 else []
    number = F.lit(0)
    for bound in sorted(set(bounds)):
        number = number + (F.unix_millis("timestamp") >= F.lit(int(bound))).cast("int")
    staged = scratch_path(spark, "slices")
    write_parquet(envelopes.withColumn("slice", number), staged, partition_by=["slice"])
    append_slices(spark, staged, out, slices, files_per_slice)
    delete_path(spark, staged)


def append_slices(spark: SparkSession, staged: str, out: str, slices: int, files_per_slice: int) -> None:
    """Append the slices of ``staged`` (``slice=0`` ..) to ``out`` one after the other, each
    written by ``files_per_slice`` tasks into exactly that many files (an empty slice into
    none).  A stream that takes ``files_per_slice`` files a micro-batch gets one slice a
    batch, in order on any store, since later slices are written later: no batch holds
    part of a slice, so nothing falls behind the watermark."""

    def n_files() -> int:
        return sum(name.startswith("part-") for name, _ in list_children(spark, out))

    for k in range(slices):
        if not path_exists(spark, f"{staged}/slice={k}"):
            continue
        part = spark.read.schema(ENVELOPE_SCHEMA).parquet(f"{staged}/slice={k}")
        there = n_files()
        write_parquet(part.repartition(files_per_slice), out, mode="append")
        for _ in range(there + files_per_slice - n_files()):  # tasks without rows wrote no file
            write_parquet(spark.createDataFrame([], ENVELOPE_SCHEMA).coalesce(1), out, mode="append")


def start_csv_publish_stream(spark: SparkSession, folder: str, bootstrap: str, topic: str, checkpoint: str,
                             max_files_per_trigger: int | None = None, trigger: str | None = None, outbox: str | None = None):
    """Stream every new CSV file dropped into ``folder`` to Kafka through ``outbox``
    (default: beside the checkpoint), which keeps the rows without a readable timestamp."""
    rows = read_events_text_stream(spark, folder, max_files_per_trigger)
    return start_publish(rows, outbox or f"{checkpoint.rstrip('/')}-outbox", checkpoint,
                         lambda batch: write_kafka(batch, bootstrap, topic), trigger)


def main(argv: list[str] | None = None) -> None:
    """``python -m eventflow.plans.producer --csv /data/events.csv --kafka kafka:9092 --topic events``
    or ``... --csv /data/events.csv --envelopes /shared/replay`` for a broker-free replay."""
    import argparse

    from eventflow.session import build_spark

    ap = argparse.ArgumentParser(description="publish raw events as keyed JSON messages")
    ap.add_argument("--csv", required=True, help="raw events CSV file or folder")
    ap.add_argument("--kafka")
    ap.add_argument("--topic", default="events")
    ap.add_argument("--envelopes", help="write envelope parquet files here instead of Kafka")
    ap.add_argument("--slices", type=int, help="with --envelopes: that many ranges of event time, written in order")
    ap.add_argument("--files-per-slice", type=int, default=8, help="files (and writing tasks) of a slice; also the number to replay a batch with")
    ap.add_argument("--rejected", help="with --kafka: folder for rows without a readable timestamp")
    args = ap.parse_args(argv)
    spark = build_spark("eventflow-producer")
    if args.envelopes:
        replay_csv_to_files(spark, args.csv, args.envelopes, args.slices, args.files_per_slice)
    elif args.kafka:
        publish_csv(spark, args.csv, args.kafka, args.topic, args.rejected)
    else:
        ap.error("give --kafka or --envelopes")


if __name__ == "__main__":
    main()
