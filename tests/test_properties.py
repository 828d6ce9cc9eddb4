"""Metamorphic and property tests (survey §5): equal results along different paths."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.functions import time as t
from eventflow.functions.messages import envelopes_from_raw, parse_envelopes
from eventflow.operators import insights as ins
from eventflow.operators.funnel import funnel
from eventflow.operators.live import event_totals
from eventflow.operators.windows import events_per_window, with_event_ts
from eventflow.plans.dashboard import load_stream_metric
from eventflow.sources.fixtures import read_fixture_events
from eventflow.streaming import queries as sq
from eventflow.streaming.sources import read_envelope_stream
from tests.conftest import SF_SMALL

MS = st.integers(min_value=-62_000_000_000_000, max_value=253_000_000_000_000)  # years 0006 .. 9987


@settings(max_examples=4, deadline=None)
@given(st.lists(MS, min_size=1, max_size=300))
def test_event_time_and_iso_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    got = df.select(
        "ms",
        t.instant_to_utc(t.ms_to_event_time("ms")).alias("et"),
        t.utc_date(t.ms_to_event_time("ms")).alias("d"),
        t.iso_utc_from_ms("ms").alias("iso"),
    ).collect()
    epoch = dt.datetime(1970, 1, 1)
    for r in got:
        secs = int(r.ms / 1000) if r.ms >= 0 else -((-r.ms) // 1000)  # toward zero
        assert r.et == epoch + dt.timedelta(seconds=secs)
        assert r.d == (epoch + dt.timedelta(seconds=secs)).date()
        wall = epoch + dt.timedelta(milliseconds=r.ms)
        assert r.iso == wall.isoformat()


@settings(max_examples=4, deadline=None)
@given(st.lists(MS, min_size=1, max_size=300))
def test_iso_parse_roundtrip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    back = df.select("ms", F.unix_millis(t.parse_utc_text(t.iso_utc_from_ms("ms"))).alias("b")).collect()
    assert all(r.ms == r.b for r in back)


def test_window_counts_sum_to_total(spark):
    raw = read_fixture_events(spark, SF_SMALL)
    metric = events_per_window(with_event_ts(raw))
    assert metric.agg(F.sum("event_count")).first()[0] == ins.total_events(raw).first().total_events


def test_live_and_batch_funnel_agree(spark):
    raw = read_fixture_events(spark, SF_SMALL)
    live = funnel(event_totals(events_per_window(with_event_ts(raw))), "event_count").first()
    batch = funnel(ins.event_distribution(raw), "count").first()
    assert tuple(live) == tuple(batch)


def test_stream_complete_equals_batch_metric(spark, tmp_path):
    raw = read_fixture_events(spark, SF_SMALL)
    src = str(tmp_path / "src")
    envelopes_from_raw(raw).write.parquet(src)
    metric = sq.metric_stream(parse_envelopes(read_envelope_stream(spark, src)))
    snap = str(tmp_path / "snap")
    q = sq.start_metric_snapshot(metric, snap, str(tmp_path / "ck"), trigger="availableNow")
    assert q.awaitTermination(300) and q.exception() is None
    streamed = load_stream_metric(spark, snap)
    batch = events_per_window(with_event_ts(raw))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


EVENTS = st.sampled_from(["view", "addtocart", "transaction", "View", None])
ROWS = st.lists(st.tuples(st.integers(-10**12, 4 * 10**12), EVENTS, st.sampled_from(["1", "2", "10", "9", None])),
                min_size=0, max_size=120)


def _raw(spark, rows):
    from tests.conftest import raw_rows

    return raw_rows(spark, [(ms, "v", ev, item, None) for ms, ev, item in rows])


@settings(max_examples=5, deadline=None)
@given(ROWS)
def test_window_metric_matches_brute_force(spark, rows):
    from collections import Counter

    want = Counter(((ms // 60_000) * 60, ev) for ms, ev, _ in rows)  # epoch-aligned minute
    m = events_per_window(with_event_ts(_raw(spark, rows)))
    got = {(r.s, r.event): r.event_count for r in
           m.select(F.unix_seconds("window_start").alias("s"), "event", "event_count").collect()}
    assert got == dict(want)


@settings(max_examples=5, deadline=None)
@given(ROWS, st.integers(1, 5))
def test_top_items_matches_brute_force(spark, rows, n):
    from collections import Counter

    views = Counter(item for _, ev, item in rows if ev == "view")
    want = sorted(views.items(), key=lambda kv: (-kv[1], (kv[0] is not None, kv[0] or "")))[:n]
    got = [tuple(r) for r in ins.top_items(_raw(spark, rows), n=n).collect()]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(ROWS)
def test_funnel_matches_formula(spark, rows):
    from collections import Counter

    c = Counter(ev for _, ev, _ in rows)
    a, b, t = c["view"], c["addtocart"], c["transaction"]
    f = funnel(ins.event_distribution(_raw(spark, rows)), "count").first()
    assert (f.view_count, f.addtocart_count, f.transaction_count) == (a, b, t)
    assert f.view_to_cart == ((b / a * 100) if a > 0 else 0)
    assert f.cart_to_tx == ((t / b * 100) if b > 0 else 0)
    assert f.overall == ((t / a * 100) if a > 0 else 0)
