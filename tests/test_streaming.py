"""Streaming behaviour with a file source of envelopes, one file per micro-batch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventflow.functions.messages import envelopes_from_raw, parse_envelopes
from eventflow.functions.time import instant_to_utc
from eventflow.plans.dashboard import load_stream_metric
from eventflow.schemas import METRIC_SCHEMA
from eventflow.streaming import queries as sq
from eventflow.streaming.sources import kafka_source_options, read_envelope_stream
from eventflow.sinks.kafka import kafka_sink_options
from tests.conftest import raw_rows

BASE = 1433221200000  # 2015-06-02 05:00:00 UTC


def _ms(minute, second):
    return BASE + (minute * 60 + second) * 1000


# Late-data scenario: {05:00:10, 05:00:20}, {05:10:00}, {05:00:30, 05:08:30 cart}, {05:00:40}
BATCHES = [
    [(_ms(0, 10), "view"), (_ms(0, 20), "view")],
    [(_ms(10, 0), "view")],
    [(_ms(0, 30), "view"), (_ms(8, 30), "addtocart")],
    [(_ms(0, 40), "view")],
]


def _write_batches(spark, src, batches, start=0):
    for i, batch in enumerate(batches, start):
        rows = raw_rows(spark, [(ts, "v", ev, "1", None) for ts, ev in batch])
        envelopes_from_raw(rows).coalesce(1).write.mode("append").parquet(src)
        # order the files for the source: modification time decides
        for name in os.listdir(src):
            p = os.path.join(src, name)
            if name.startswith("part-") and os.path.getmtime(p) > 1e9 + 10_000:
                os.utime(p, (1e9 + i, 1e9 + i))


def _metric(spark, src):
    return sq.metric_stream(parse_envelopes(read_envelope_stream(spark, src, max_files_per_trigger=1)))


def _count_at_05(df):
    rows = df.filter(instant_to_utc("window_start") == F.lit(dt.datetime(2015, 6, 2, 5, 0))).collect()
    return [r.event_count for r in rows]


def _run(q):
    assert q.awaitTermination(300)
    assert q.exception() is None


def test_output_modes_on_late_data(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES)
    # complete: everything counted, late rows too
    snap = str(tmp_path / "snap")
    _run(sq.start_metric_snapshot(_metric(spark, src), snap, str(tmp_path / "c1"), trigger="availableNow"))
    assert _count_at_05(load_stream_metric(spark, snap)) == [4]
    # append: 05:00 emitted once, with 3 (05:00:40 arrives after the watermark passed)
    app = str(tmp_path / "app")
    _run(sq.start_metric_append(_metric(spark, src), app, str(tmp_path / "c2"), trigger="availableNow"))
    appended = spark.read.schema(METRIC_SCHEMA).parquet(app)
    assert _count_at_05(appended) == [3]
    # update: last value per key is 3
    upd = str(tmp_path / "upd")
    _run(sq.start_metric_updates(_metric(spark, src), upd, str(tmp_path / "c3"), trigger="availableNow"))
    assert _count_at_05(sq.latest_updates(spark, upd)) == [3]


def test_restart_from_checkpoint(spark, tmp_path):
    """State and offsets come back from the checkpoint: files of the first run are
    not read again and the window keeps counting."""
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write_batches(spark, src, BATCHES[:1])
    _run(sq.start_metric_updates(_metric(spark, src), out, ckpt, trigger="availableNow"))
    _write_batches(spark, src, [[(_ms(0, 30), "view"), (_ms(0, 50), "view")]], start=1)
    _run(sq.start_metric_updates(_metric(spark, src), out, ckpt, trigger="availableNow"))
    assert _count_at_05(sq.latest_updates(spark, out)) == [4]


def test_late_after_restart(spark, tmp_path):
    """The end of an availableNow run moves the watermark (no-data batch), so a row
    older than it that arrives after the restart is dropped as late."""
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write_batches(spark, src, BATCHES[:2])
    _run(sq.start_metric_updates(_metric(spark, src), out, ckpt, trigger="availableNow"))
    _write_batches(spark, src, BATCHES[2:], start=2)
    _run(sq.start_metric_updates(_metric(spark, src), out, ckpt, trigger="availableNow"))
    assert _count_at_05(sq.latest_updates(spark, out)) == [2]


def test_snapshot_versions_and_rows_written(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES)
    snap = str(tmp_path / "snap")
    writer = sq.snapshot_writer(snap, keep=2)
    q = (_metric(spark, src).writeStream.outputMode("complete").foreachBatch(writer)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    _run(q)
    versions = sorted(n for n in os.listdir(snap) if n.startswith("batch="))
    assert len(versions) == 2  # older snapshots pruned
    assert writer.rows_written[-1][1] == load_stream_metric(spark, snap).count()


def test_failing_sink_fails_the_query(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:1])

    def broken(df, batch_id):
        raise RuntimeError("sink down")

    q = (_metric(spark, src).writeStream.outputMode("update").foreachBatch(broken)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination(300)
    assert q.exception() is not None


def test_archive_and_quarantine(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:2])
    junk = spark.createDataFrame([("not json",)], "v string").select(
        F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"))
    junk.write.mode("append").parquet(src)
    raw = read_envelope_stream(spark, src)
    outs = {"archive": str(tmp_path / "arch"), "quarantine": str(tmp_path / "quar")}
    started = sq.start_all(raw, outs, str(tmp_path / "ck"),
                           triggers={"archive": "availableNow", "quarantine": "availableNow"})
    for q in started.values():
        _run(q)
    assert spark.read.parquet(outs["archive"]).count() == 3
    assert [r.json_str for r in spark.read.parquet(outs["quarantine"]).collect()] == ["not json"]


def test_start_failure_policy(spark, tmp_path):
    (tmp_path / "src").mkdir()
    raw = read_envelope_stream(spark, str(tmp_path / "src"))
    with pytest.raises(ValueError):
        sq.start_all(raw, {"nope": "x"}, str(tmp_path / "ck"))


def test_kafka_options():
    src = kafka_source_options("kafka:9092", "events")
    assert src == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "events",
                   "startingOffsets": "latest", "failOnDataLoss": "true"}
    more = kafka_source_options("kafka:9092", "events", minPartitions=64, maxOffsetsPerTrigger=100000)
    assert more["minPartitions"] == "64" and more["maxOffsetsPerTrigger"] == "100000"
    sink = kafka_sink_options("kafka:9092", "events")
    assert sink["kafka.acks"] == "all" and sink["kafka.linger.ms"] == "50" and sink["topic"] == "events"


def test_trigger_kwargs():
    assert sq.trigger_kwargs("availableNow") == {"availableNow": True}
    assert sq.trigger_kwargs("15 seconds") == {"processingTime": "15 seconds"}
    assert sq.trigger_kwargs(None) == {}


def test_single_file_snapshot_is_newest_first(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES)
    snap = str(tmp_path / "snap")
    _run(sq.start_metric_snapshot(_metric(spark, src), snap, str(tmp_path / "ck"), trigger="availableNow",
                                  single_file=True))
    latest = sorted(n for n in os.listdir(snap) if n.startswith("batch="))[-1]
    parts = [n for n in os.listdir(os.path.join(snap, latest)) if n.startswith("part-")]
    assert len(parts) == 1
    lines = open(os.path.join(snap, latest, parts[0])).read().splitlines()[1:]
    starts = [ln.split(",")[0] for ln in lines]
    assert starts == sorted(starts, reverse=True) and len(starts) == 3


def test_console_sink_runs(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:1])
    _run(sq.start_console(_metric(spark, src), str(tmp_path / "ck"), trigger="availableNow", num_rows=5))


def test_archive_partitioned_by_date(spark, tmp_path):
    from eventflow.sources.files import read_archive

    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES)
    parsed = parse_envelopes(read_envelope_stream(spark, src))
    out = str(tmp_path / "arch")
    _run(sq.start_archive(parsed, out, str(tmp_path / "ck"), trigger="availableNow", partition_by_date=True))
    assert sorted(os.listdir(out)) == ["_spark_metadata", "event_date=2015-06-02"]
    assert read_archive(spark, out).count() == 6
    # a date range prunes partitions
    days = read_archive(spark, out, "2015-06-02", "2015-06-02")
    assert days.count() == 6 and read_archive(spark, out, "2015-06-03").count() == 0
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_stop_gracefully(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:1])
    q = sq.start_metric_updates(_metric(spark, src), str(tmp_path / "out"), str(tmp_path / "ck"), trigger="1 second")
    q.processAllAvailable()
    sq.stop_gracefully([q], timeout_s=30)
    assert not q.isActive and q.exception() is None
    assert _count_at_05(sq.latest_updates(spark, str(tmp_path / "out"))) == [2]


def test_replayed_file_is_counted_twice_in_complete_mode(spark, tmp_path):
    """V17 on the stream: the producer's second pass over the file repeats old event
    times; complete mode counts them again."""
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:1] + BATCHES[:1])
    snap = str(tmp_path / "snap")
    _run(sq.start_metric_snapshot(_metric(spark, src), snap, str(tmp_path / "ck"), trigger="availableNow"))
    assert _count_at_05(load_stream_metric(spark, snap)) == [4]


def test_start_failure_tolerated_or_raised(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:1])
    raw = read_envelope_stream(spark, src)
    outs = {"archive": str(tmp_path / "arch"), "console": "-"}
    bad = {"archive": "availableNow", "console": "not an interval"}
    started = sq.start_all(raw, outs, str(tmp_path / "ck1"), triggers=bad, tolerate_start_failures=True)
    assert isinstance(started["console"], Exception)
    _run(started["archive"])
    with pytest.raises(Exception):
        sq.start_all(raw, outs, str(tmp_path / "ck2"), triggers=bad)
    assert not any(q.isActive for q in spark.streams.active)


def test_state_partitions_set_for_one_query(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_batches(spark, src, BATCHES[:1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = sq.start_metric_append(_metric(spark, src), str(tmp_path / "out"), str(tmp_path / "ck"),
                               trigger="availableNow", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    _run(q)
    assert {op["numShufflePartitions"] for p in q.recentProgress for op in p["stateOperators"]} == {3}


def test_kafka_paths_need_only_the_connector(spark, tmp_path):
    """Without the spark-sql-kafka package the reader and writers fail at format
    lookup, naming the missing source; everything before that is exercised."""
    from eventflow.functions.messages import to_envelope, normalize_rows
    from eventflow.sinks.kafka import write_kafka
    from eventflow.streaming.sources import read_kafka_stream
    from tests.conftest import raw_rows

    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        pytest.skip("Kafka connector present")
    except Exception:
        pass
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, "localhost:9", "events", maxOffsetsPerTrigger=10)
    env = to_envelope(normalize_rows(raw_rows(spark, [(BASE, "v", "view", "1", None)])))
    with pytest.raises(Exception, match="(?i)kafka"):
        write_kafka(env, "localhost:9", "events")


@pytest.mark.parametrize("start, prefix", [(sq.start_metric_snapshot, "batch="), (sq.start_metric_updates, "batch_id=")])
def test_new_checkpoint_beside_old_versions_is_refused(spark, tmp_path, start, prefix):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    _write_batches(spark, src, BATCHES)
    _run(start(_metric(spark, src), out, str(tmp_path / "ck"), trigger="availableNow"))
    before = sorted(n for n in os.listdir(out) if n.startswith(prefix))
    with pytest.raises(ValueError, match="another checkpoint"):
        start(_metric(spark, src), out, str(tmp_path / "new"), trigger="availableNow")
    assert sorted(n for n in os.listdir(out) if n.startswith(prefix)) == before
    _run(start(_metric(spark, src), out, str(tmp_path / "ck"), trigger="availableNow"))  # its own may go on


def test_landing_parses_once_and_feeds_the_metric(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    _write_batches(spark, src, BATCHES[:2])
    junk = spark.createDataFrame([("not json",), ("{}",)], "v string").select(
        F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    junk.write.mode("append").parquet(src)
    raw = read_envelope_stream(spark, src)
    landed = sq.start_landing(raw, out, str(tmp_path / "ck"), trigger="availableNow")
    _run(landed)
    rows = spark.read.schema(sq.LANDED_SCHEMA).parquet(out)
    assert sorted(r.json_str for r in rows.filter("kind = 'junk'").collect()) == ["not json", "{}"]
    assert rows.filter("kind = 'event' AND json_str IS NULL").count() == 3
    stream = sq.read_landed_stream(spark, out)
    assert "from_json" not in stream._jdf.queryExecution().analyzed().toString()
    _run(sq.start_metric_append(sq.metric_stream(stream), str(tmp_path / "metric"), str(tmp_path / "ck2"), trigger="availableNow"))
    assert _count_at_05(spark.read.schema(METRIC_SCHEMA).parquet(str(tmp_path / "metric"))) == [2]


def test_time_sliced_replay_runs_in_order(spark, tmp_path):
    """A replay written in time slices streams one slice per micro-batch, in event
    time order, so append mode loses nothing to the watermark."""
    from eventflow.plans.producer import replay_csv_to_files
    from eventflow.sinks.files import write_csv
    from eventflow.sources.fixtures import read_fixture_events
    from tests.conftest import SF_SMALL

    raw = read_fixture_events(spark, SF_SMALL)
    csv = str(tmp_path / "raw")
    write_csv(raw.orderBy(F.rand(7)), csv)  # shuffled rows
    env = str(tmp_path / "env")
    replay_csv_to_files(spark, csv, env, slices=4)
    assert len([n for n in os.listdir(env) if n.startswith("part-")]) == 4
    metric = sq.metric_stream(parse_envelopes(read_envelope_stream(spark, env, max_files_per_trigger=1)))
    out = str(tmp_path / "out")
    q = sq.start_metric_append(metric, out, str(tmp_path / "ck"), trigger="availableNow")
    _run(q)
    assert sum(p["numInputRows"] for p in q.recentProgress) == raw.count()
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 4
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 0


def test_json_message_files(spark, tmp_path):
    """JSON-lines messages from another producer: parsed like envelopes, junk
    quarantined, a message without event_time placed at the file's time."""
    from eventflow.streaming.sources import read_message_files

    d = tmp_path / "msgs"
    d.mkdir()
    (d / "a.jsonl").write_text(
        '{"timestamp":1433221210000,"event_time":"2015-06-02T05:00:10","visitorid":"1","event":"view"}\n'
        'not json\n'
        '{"timestamp":1433221230000,"event_time":"2015-06-02T05:00:30","visitorid":"2","event":"view"}\n'
        '{"visitorid":"3","event":"addtocart"}\n')
    static = parse_envelopes(read_message_files(spark, str(d), streaming=False))
    assert static.count() == 3
    no_time = static.filter("visitorid = '3'").first()
    assert no_time.event_ts == no_time.kafka_ts and no_time.event_ts is not None
    metric = sq.metric_stream(parse_envelopes(read_message_files(spark, str(d))))
    snap = str(tmp_path / "snap")
    _run(sq.start_metric_snapshot(metric, snap, str(tmp_path / "ck"), trigger="availableNow"))
    assert _count_at_05(load_stream_metric(spark, snap)) == [2]
