"""Event message codec: raw row -> JSON message -> keyed envelope -> parsed row.

All built-in expressions, so normalising and parsing run inside whole-stage
codegen on the executors; there is no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.time import (
    iso_utc_from_instant,
    iso_utc_from_ms,
    ms_to_instant,
    parse_utc_text,
    representable_ms,
)
from eventflow.schemas import CORRUPT_COLUMN, MESSAGE_COLUMNS, MESSAGE_SCHEMA

MALFORMED_POLICIES = ("quarantine", "count")


def normalize_rows(rows: DataFrame, ingest_time: Column | None = None, *keep: str) -> DataFrame:
    """Raw rows (typed or all-text) -> the 7 message fields plus ``ts_defaulted`` and the
    columns named in ``keep``.

    * ``timestamp``: a whole number, else the current time in ms (``ts_defaulted``
      tells which rows got it, so a caller can drop them before a watermark);
    * ``event_time``: naive UTC ISO text of ``timestamp`` (Python ``isoformat`` form);
    * ``transactionid``: empty text -> NULL; other fields are kept as they are;
    * ``ingest_time``: ``ingest_time`` or the current time, naive UTC ISO text.
    """
    ts = F.col("timestamp")
    if isinstance(rows.schema["timestamp"].dataType, T.StringType):
        ts = F.trim(ts).try_cast("long")
    ts = representable_ms(ts)  # a number that is no instant counts as unreadable
    now_ms = F.unix_millis(F.current_timestamp())
    ingest = ingest_time if ingest_time is not None else F.current_timestamp()
    return (
        rows.withColumn("_ts", ts)
        .select(
            F.coalesce(F.col("_ts"), now_ms).alias("timestamp"),
            iso_utc_from_ms(F.coalesce(F.col("_ts"), now_ms)).alias("event_time"),
            F.col("visitorid").cast("string").alias("visitorid"),
            F.col("event").cast("string").alias("event"),
            F.col("itemid").cast("string").alias("itemid"),
            F.nullif(F.col("transactionid").cast("string"), F.lit("")).alias("transactionid"),
            iso_utc_from_instant(ingest).alias("ingest_time"),
            F.col("_ts").isNull().alias("ts_defaulted"),
            *keep,
        )
    )


def message_json(messages: DataFrame) -> Column:
    """The JSON text of a message; NULL fields are written as ``null``."""
    return F.to_json(F.struct(*[F.col(c) for c in MESSAGE_COLUMNS]), {"ignoreNullFields": "false"})


def to_envelope(messages: DataFrame, broker_time: Column | None = None) -> DataFrame:
    """Messages -> ``(key, value, timestamp)`` records keyed by visitor.

    ``key`` is the visitor id as UTF-8 bytes (NULL stays NULL), ``value`` the JSON
    bytes.  ``broker_time`` fills ``timestamp`` for file replays; a Kafka sink
    ignores it and stamps its own.
    """
    return messages.select(
        F.col("visitorid").cast("binary").alias("key"),
        message_json(messages).cast("binary").alias("value"),
        (broker_time if broker_time is not None else F.current_timestamp()).alias("timestamp"),
    )


def _parse_schema() -> T.StructType:
    return T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def decode_envelopes(raw: DataFrame) -> DataFrame:
    """Envelopes -> message fields + ``kafka_ts`` + ``json_str`` + ``malformed``.

    PERMISSIVE parsing: a wrong type in one field makes that field NULL and keeps
    the others.  ``malformed`` is true when not one field could be read: junk text, an
    empty or NULL value, and also valid JSON without any known field, such as ``{}``.

    The parsed struct is unpacked with ``inline(array(...))`` rather than a plain
    projection: Catalyst pushes a filter on projected fields below the projection
    and repeats ``from_json`` once per referenced field, while predicates on a
    generator's output stay above it, so each record is parsed exactly once.
    """
    value = F.col("value").cast("string")
    parsed = raw.select(
        F.inline(
            F.array(
                F.from_json(
                    value, _parse_schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
                )
            )
        ),
        F.col("timestamp").alias("kafka_ts"),
        value.alias("json_str"),
    )
    no_field = F.lit(True)
    for c in MESSAGE_COLUMNS:
        no_field = no_field & F.col(c).isNull()
    return parsed.select(*MESSAGE_COLUMNS, "kafka_ts", "json_str", no_field.alias("malformed"))


def with_event_ts(decoded: DataFrame) -> DataFrame:
    """Event time = parsed ``event_time`` (naive text read as UTC), else broker time.
    A malformed ``event_time`` falls back too; nothing raises under ANSI mode."""
    return decoded.withColumn("event_ts", F.coalesce(parse_utc_text("event_time"), F.col("kafka_ts")))


def parse_envelopes(raw: DataFrame, on_malformed: str = "quarantine") -> DataFrame:
    """Envelopes -> ``MESSAGE_COLUMNS + kafka_ts + event_ts``.

    ``on_malformed="quarantine"`` drops records with no readable field (read them
    with :func:`malformed_records`); ``"count"`` keeps them as a NULL event at broker
    time, which is the old behaviour and lets one junk record move the watermark.
    """
    if on_malformed not in MALFORMED_POLICIES:
        raise ValueError(f"on_malformed must be one of {MALFORMED_POLICIES}")
    decoded = decode_envelopes(raw)
    if on_malformed == "quarantine":
        decoded = decoded.filter(~F.col("malformed"))
    return with_event_ts(decoded).select(*MESSAGE_COLUMNS, "kafka_ts", "event_ts")


def malformed_records(raw: DataFrame) -> DataFrame:
    """The quarantined records: raw text and broker time."""
    return decode_envelopes(raw).filter(F.col("malformed")).select("json_str", "kafka_ts")


def envelopes_from_raw(rows: DataFrame) -> DataFrame:
    """Replay helper: raw rows -> envelopes stamped with their own event instant as
    broker time (as if produced live).  The ingest time is the event instant too, so
    a replay is deterministic."""
    messages = normalize_rows(rows, ingest_time=ms_to_instant("timestamp"))
    return to_envelope(messages, broker_time=ms_to_instant("timestamp"))
