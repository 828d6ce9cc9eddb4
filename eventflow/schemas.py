"""Fixed, explicit, all-nullable schemas.  Nothing is inferred."""

from pyspark.sql import types as T

# D1: raw clickstream row (CSV with header; columns bind by name, see sources.files)
RAW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),  # epoch milliseconds, UTC
        T.StructField("visitorid", T.StringType(), True),
        T.StructField("event", T.StringType(), True),
        T.StructField("itemid", T.StringType(), True),
        T.StructField("transactionid", T.StringType(), True),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# The same columns as text, for the message normaliser (the producer reads strings).
RAW_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType(), True) for f in RAW_SCHEMA.fields])

# D3: the JSON event message
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("event_time", T.StringType(), True),  # naive UTC ISO-8601
        T.StructField("visitorid", T.StringType(), True),
        T.StructField("event", T.StringType(), True),
        T.StructField("itemid", T.StringType(), True),
        T.StructField("transactionid", T.StringType(), True),
        T.StructField("ingest_time", T.StringType(), True),  # naive UTC ISO-8601
    ]
)
MESSAGE_COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields]

# Name of the field that keeps the text of a record from_json could not read.
CORRUPT_COLUMN = "_corrupt_record"

# D4: log record envelope, the shape of a Kafka source row that we use
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# D6: the window metric
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("window_end", T.TimestampType(), True),
        T.StructField("event", T.StringType(), True),
        T.StructField("event_count", T.LongType(), True),
    ]
)

# D8: batch results
TOP_ITEMS_SCHEMA = T.StructType(
    [T.StructField("itemid", T.StringType(), True), T.StructField("view_count", T.LongType(), True)]
)
EVENT_DISTRIBUTION_SCHEMA = T.StructType(
    [T.StructField("event", T.StringType(), True), T.StructField("count", T.LongType(), True)]
)
DAILY_VISITORS_SCHEMA = T.StructType(
    [T.StructField("event_date", T.DateType(), True), T.StructField("active_visitors", T.LongType(), True)]
)

RESULT_SCHEMAS = {
    "top_items": TOP_ITEMS_SCHEMA,
    "event_distribution": EVENT_DISTRIBUTION_SCHEMA,
    "daily_visitors": DAILY_VISITORS_SCHEMA,
    "events_per_minute": METRIC_SCHEMA,
}
