"""Publishing a stream of raw text rows, with everything that cannot be published kept.

Each batch is written once, in one pass, into a folder of its own: its messages under
``kind=message``, rows without a readable timestamp under ``kind=rejected`` with all their
fields as they came (an empty field stays empty, a missing one is missing).  The messages
are then sent from there.  A repeated batch replaces its own folder, and a batch that is
marked as sent is not sent again; a kill between sending and marking sends it twice, which
a broker without transactions cannot rule out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow.functions.messages import message_json, normalize_rows
from eventflow.schemas import RAW_COLUMNS
from eventflow.sources.files import create_text, list_children, path_exists
from eventflow.streaming.control import BatchWriter, start_batches

SENT = "_sent"
OUTBOX_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True), T.StructField("value", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True), T.StructField("kind", T.StringType(), True)])

Send = Callable[[DataFrame], None]


def outbox_rows(rows: DataFrame) -> DataFrame:
    """Raw text rows -> key, value, kind: JSON messages keyed by visitor, or the row itself
    as JSON where it has no readable timestamp."""
    raw = rows.select(*RAW_COLUMNS, F.to_json(F.struct(*RAW_COLUMNS)).alias("raw_row"))
    messages = normalize_rows(raw, None, "raw_row")
    bad = F.col("ts_defaulted")
    return messages.select(
        F.when(~bad, F.col("visitorid")).alias("key"), F.when(bad, F.col("raw_row")).otherwise(message_json(messages)).alias("value"),
        F.when(bad, F.lit("rejected")).otherwise(F.lit("message")).alias("kind"))


def outbox_writer(outbox: str, send: Send | None = None) -> BatchWriter:
    """``foreachBatch`` function over raw text rows.  ``send`` gets the messages of a batch
    (``key`` and ``value`` as binary, as a Kafka sink takes them)."""
    base = outbox.rstrip("/")

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        outbox_rows(rows).write.mode("overwrite").partitionBy("kind").parquet(f"{base}/batch_id={batch_id}")
        if send is None or path_exists(spark, f"{base}/{SENT}/{batch_id}"):
            return
        batch = read_outbox(spark, base).filter((F.col("batch_id") == batch_id) & (F.col("kind") == "message"))
        send(batch.select(F.col("key").cast("binary"), F.col("value").cast("binary")))
        create_text(spark, f"{base}/{SENT}/{batch_id}", "", overwrite=True)

    return write


def read_outbox(spark: SparkSession, outbox: str) -> DataFrame:
    """key, value, batch_id, kind of all batches; empty if there are none."""
    if not any(n.startswith("batch_id=") for n, _ in list_children(spark, outbox)):
        return spark.createDataFrame([], OUTBOX_SCHEMA)
    return spark.read.schema(OUTBOX_SCHEMA).option("basePath", outbox).parquet(outbox)


def rejected_rows(spark: SparkSession, outbox: str) -> DataFrame:
    """The rejected rows, every field as text as it came."""
    fields = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])
    rows = read_outbox(spark, outbox).filter(F.col("kind") == "rejected")
    return rows.select("batch_id", F.from_json("value", fields).alias("row")).select("batch_id", "row.*")


def start_publish(rows: DataFrame, outbox: str, checkpoint: str, send: Send | None = None, trigger: str | None = None,
                  wrap: Callable[[BatchWriter], BatchWriter] | None = None) -> StreamingQuery:
    """Publish a stream of raw text rows through ``outbox``."""
    write = outbox_writer(outbox, send)
    return start_batches(rows, wrap(write) if wrap else write, checkpoint, trigger)
