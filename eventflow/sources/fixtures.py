"""Adapter from the synthetic ``events`` table onto the raw clickstream schema.

``events(event_id, ts timestamp_ntz, user_id, event_type, value, props)`` becomes
``timestamp, visitorid, event, itemid, transactionid`` (see ``schemas.RAW_SCHEMA``).
The three funnel event types get their clickstream names; every other value, and
NULL, passes through unchanged, and no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.time import utc_epoch_ms

# Synthetic event type -> clickstream event name.
EVENT_MAP = {"view": "view", "click": "addtocart", "purchase": "transaction"}
# All event names of the adapted table.
EVENT_NAMES = ("view", "addtocart", "transaction", "error", "signup")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def adapt_events(src: DataFrame, *keep: str) -> DataFrame:
    """Map synthetic events onto the raw clickstream schema (lazy projection); ``keep``
    names columns of the source to carry along."""
    event = F.col("event_type")
    for source_type, name in reversed(EVENT_MAP.items()):
        event = F.when(F.col("event_type") == source_type, F.lit(name)).otherwise(event)
    return src.select(
        utc_epoch_ms("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("visitorid"),
        event.alias("event"),
        F.get_json_object("props", "$.k").alias("itemid"),
        F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).alias("transactionid"),
        *keep,
    )


def read_fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapted raw clickstream of one synthetic scale factor."""
    return adapt_events(spark.read.parquet(table_path(sf_dir, "events")))
