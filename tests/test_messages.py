import datetime as dt
import json
import time

from pyspark.sql import functions as F

from eventflow.functions import messages as m
from eventflow.functions.time import instant_to_utc
from eventflow.schemas import RAW_TEXT_SCHEMA


def _text_rows(spark, rows):
    return spark.createDataFrame(rows, RAW_TEXT_SCHEMA)


def test_normalize_rows(spark):
    before = int(time.time() * 1000)
    rows = _text_rows(spark, [
        ("1433221332117", "1", "view", "5", ""),
        ("x", "", "view", "5", "77"),  # bad producer timestamp -> now; "" visitor stays ""
        (" 1433221332000 ", None, None, None, None),
    ])
    out = m.normalize_rows(rows).collect()
    assert out[0].timestamp == 1433221332117 and out[0].event_time == "2015-06-02T05:02:12.117000"
    assert out[0].transactionid is None and not out[0].ts_defaulted
    assert out[1].ts_defaulted and before <= out[1].timestamp <= int(time.time() * 1000) + 1000
    assert out[1].visitorid == "" and out[1].transactionid == "77"
    assert out[2].timestamp == 1433221332000 and out[2].event_time == "2015-06-02T05:02:12"
    assert out[2].visitorid is None


def test_envelope_json_keeps_nulls_and_key(spark):
    rows = _text_rows(spark, [("1433221332117", "9", "view", "5", None), ("1433221332117", None, "view", "5", None)])
    env = m.to_envelope(m.normalize_rows(rows)).collect()
    assert bytes(env[0].key) == b"9" and env[1].key is None
    doc = json.loads(bytes(env[0].value).decode())
    assert list(doc) == ["timestamp", "event_time", "visitorid", "event", "itemid", "transactionid", "ingest_time"]
    assert doc["transactionid"] is None and doc["timestamp"] == 1433221332117


def _env(spark, values, broker="2020-01-01 00:00:00"):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return df.select(
        F.col("v").cast("binary").alias("key"),
        F.col("v").cast("binary").alias("value"),
        F.lit(broker).cast("timestamp_ntz").cast("timestamp").alias("timestamp"),
    )


def test_parse_rules(spark, la_zone):
    values = [
        '{"timestamp":1433221332117,"event_time":"2015-06-02T05:02:12.117000","event":"view","itemid":7}',
        '{"timestamp":"12","event":"view"}',  # long as text -> NULL, event kept
        '{"event":"view"}',  # no event_time -> broker time
        '{"event_time":"garbage","event":"cart"}',  # malformed time -> broker time, no error
        "not json",  # quarantined
    ]
    env = _env(spark, values)
    # the broker literal above is read in the LA session zone; compare as instants
    broker = env.select(instant_to_utc("timestamp")).first()[0]
    rows = m.parse_envelopes(env).select("timestamp", "event", "itemid", instant_to_utc("event_ts").alias("ts")).collect()
    assert len(rows) == 4
    assert rows[0].itemid == "7" and rows[0].ts == dt.datetime(2015, 6, 2, 5, 2, 12, 117000)
    assert rows[1].timestamp is None and rows[1].event == "view"
    assert rows[2].ts == broker and rows[3].ts == broker
    bad = m.malformed_records(env).collect()
    assert [r.json_str for r in bad] == ["not json"]


def test_malformed_count_policy(spark):
    env = _env(spark, ["not json", '{"event":"view"}'])
    rows = m.parse_envelopes(env, on_malformed="count").collect()
    assert len(rows) == 2 and rows[0].event is None and rows[0].event_ts == rows[0].kafka_ts


def test_quarantine_parses_once(spark):
    plan = m.parse_envelopes(_env(spark, ["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_roundtrip_equals_source(spark):
    from eventflow.sources.fixtures import read_fixture_events
    from tests.conftest import SF_SMALL

    raw = read_fixture_events(spark, SF_SMALL)
    back = m.parse_envelopes(m.envelopes_from_raw(raw)).select(*raw.columns)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
