"""The metric's snapshot by days."""

import os

from pyspark.sql import functions as F

from eventflow.functions.messages import envelopes_from_raw, parse_envelopes
from eventflow.operators.windows import events_per_window, with_event_ts
from eventflow.streaming import queries as sq
from eventflow.streaming.control import StopGate, run_to_end, run_with_restarts, start_batches
from eventflow.streaming.snapshots import day_files, day_snapshot_writer, last_commit, read_day_snapshot, start_day_snapshot
from eventflow.streaming.sources import read_envelope_stream
from tests.conftest import raw_rows

DAY = 86_400_000
BASE = 1433203200000  # 2015-06-02 00:00 UTC


def _append(spark, src, rows):
    envelopes_from_raw(raw_rows(spark, rows)).coalesce(1).write.mode("append").parquet(src)


def _day_rows(day, n=200, events=("view", "addtocart")):
    return [(BASE + day * DAY + 3_600_000 + i * 60_000 + k, f"v{i % 7}", e, "1", None) for i in range(n) for k, e in enumerate(events)]


def _metric(spark, src):
    return sq.metric_stream(parse_envelopes(read_envelope_stream(spark, src, 1)))


def _key(df):
    return sorted(((r.s, r.e, r.event, r.event_count) for r in df.select(
        F.unix_seconds("window_start").alias("s"), F.unix_seconds("window_end").alias("e"), "event", "event_count").collect()), key=repr)


def _size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".csv"))


def test_equals_a_batch_and_bytes_do_not_grow(spark, tmp_path):
    src, snap, ck = (str(tmp_path / n) for n in ("src", "snap", "ck"))
    rows, written = [], []
    assert read_day_snapshot(spark, snap).collect() == []
    for day in range(6):
        new = _day_rows(day)
        _append(spark, src, new)
        rows += new
        run_to_end(start_day_snapshot(_metric(spark, src), snap, ck, "availableNow"))
        batch = last_commit(spark, snap)
        written.append(sum(_size(os.path.join(snap, d, b)) for d in os.listdir(snap) if d.startswith("day=")
                           for b in os.listdir(os.path.join(snap, d)) if int(b[6:]) > (written and seen or -1)))
        seen = batch
        assert _key(read_day_snapshot(spark, snap)) == _key(events_per_window(with_event_ts(raw_rows(spark, rows))))
    assert max(written[1:]) <= 1.2 * written[0]  # a trigger writes its own day, however many there are
    assert len(day_files(spark, snap)) == 6
    assert {r.d for r in read_day_snapshot(spark, snap, "2015-06-03", "2015-06-04").select(F.to_date("window_start").alias("d")).collect()} \
        == {r.d for r in spark.sql("select explode(sequence(date'2015-06-03', date'2015-06-04')) as d").collect()}


def test_file_names_run_newest_first(spark, tmp_path):
    src, snap = str(tmp_path / "src"), str(tmp_path / "snap")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _append(spark, src, _day_rows(0, 600))
        run_to_end(start_day_snapshot(_metric(spark, src), snap, str(tmp_path / "ck"), "availableNow"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    (folder,) = day_files(spark, snap)
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    assert len(names) > 1
    stamps = [line.split(",")[0] for n in names for line in open(os.path.join(folder, n)).read().splitlines()[1:]]
    assert len(stamps) == 1200 and stamps == sorted(stamps, reverse=True)


def test_counts_grow_late_rows_drop_and_versions_are_pruned(spark, tmp_path):
    src, snap, ck = (str(tmp_path / n) for n in ("src", "snap", "ck"))
    at = BASE + 3_600_000
    for batch in ([(at, "a", "view", "1", None)], [(at + 1000, "a", "view", "1", None)], [(at + 2000, "b", "view", "1", None)],
                  [(at + 600_000, "b", "view", "1", None)], [(at + 600_001, "b", "view", "1", None)], [(at + 3000, "c", "view", "1", None)]):
        _append(spark, src, batch)
        run_to_end(start_day_snapshot(_metric(spark, src), snap, ck, "availableNow"))
    assert [k[3] for k in _key(read_day_snapshot(spark, snap))] == [3, 2]  # the last row came too late
    assert len(os.listdir(os.path.join(snap, "day=2015-06-02"))) == 2
    assert sum(n.isdigit() for n in os.listdir(os.path.join(snap, "_commits"))) <= 2


def test_any_event_text_survives_the_csv(spark, tmp_path):
    names = ["", " ", " lead", "trail ", 'quo"te', "com,ma", "line\nend", "back\\slash", "View", "view", None]
    src, snap, ck = (str(tmp_path / n) for n in ("src", "snap", "ck"))
    rows = [(BASE + 1000, "v", e, "1", None) for e in names]
    for _ in range(2):
        _append(spark, src, rows)
    run_to_end(start_day_snapshot(_metric(spark, src), snap, ck, "availableNow"))
    got = {r.event: r.event_count for r in read_day_snapshot(spark, snap).collect()}
    assert got == dict.fromkeys(names, 2)


def test_failures_before_during_and_after_the_write(spark, tmp_path):
    src, snap, ck = (str(tmp_path / n) for n in ("src", "snap", "ck"))
    rows = []
    for day in range(4):
        part = _day_rows(day, 30) + _day_rows(max(day - 1, 0), 3, ("late-ish",))
        rows += part if day == 0 else _day_rows(day, 30)
        _append(spark, src, part if day == 0 else _day_rows(day, 30))
    faults = {0: "before", 1: "torn", 2: "after", 3: "torn"}
    inner = day_snapshot_writer(snap)

    def sink(df, batch_id):
        fault = faults.pop(batch_id, None)
        if fault == "before":
            raise OSError("before")
        if fault == "torn":  # half of the batch's days written, no commit
            df.filter("event = 'view'").withColumn("day", F.to_date("window_start").cast("string")).withColumn(
                "batch", F.lit(batch_id)).write.mode("append").option("header", True).partitionBy("day", "batch").csv(snap)
            torn = read_day_snapshot(spark, snap)  # readers are still at the batch before
            assert torn.filter("event_count is null").count() == 0 and last_commit(spark, snap) == batch_id - 1
            raise OSError("torn")
        inner(df, batch_id)
        if fault == "after":
            raise OSError("after")

    seen = []
    run_with_restarts(lambda: start_batches(_metric(spark, src), sink, ck, "availableNow", "update"), on_failure=seen.append)
    assert len(seen) == 4
    assert _key(read_day_snapshot(spark, snap)) == _key(events_per_window(with_event_ts(raw_rows(spark, rows))))


def test_stop_and_resume(spark, tmp_path):
    src, snap, ck = (str(tmp_path / n) for n in ("src", "snap", "ck"))
    rows = []
    for day in range(4):
        rows += _day_rows(day, 20)
        _append(spark, src, _day_rows(day, 20))
    gate = StopGate(2)
    assert not run_to_end(start_day_snapshot(_metric(spark, src), snap, ck, "availableNow", wrap=gate.guard))
    assert len(day_files(spark, snap)) == 2
    assert run_to_end(start_day_snapshot(_metric(spark, src), snap, ck, "availableNow"))
    assert _key(read_day_snapshot(spark, snap)) == _key(events_per_window(with_event_ts(raw_rows(spark, rows))))


def test_streaming_job_and_dashboard_read_it(spark, tmp_path):
    from eventflow.plans.dashboard import load_stream_metric
    from eventflow.plans.streaming_job import run_streaming_job

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = _day_rows(0, 20) + _day_rows(1, 20)
    _append(spark, src, rows)
    run_streaming_job(spark, read_envelope_stream(spark, src), out, str(tmp_path / "ck"), available_now=True, day_snapshot=True)
    shown = load_stream_metric(spark, f"{out}/day-snapshot/events_per_minute")
    assert _key(shown) == _key(events_per_window(with_event_ts(raw_rows(spark, rows))))
