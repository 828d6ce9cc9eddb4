from pathlib import Path

import pytest

from eventflow.plans.batch import load_csv_results, run_batch_job
from eventflow.plans.dashboard import batch_view
from eventflow.sinks.publish import results_folder

HEADER = "timestamp,visitorid,event,itemid,transactionid\n"
ROWS = [
    "1433221332117,1,view,10,",
    "1433221332117,2,view,10,",
    "1433221332117,2,addtocart,10,",
    "1433307732117,3,view,11,",
    "1433307732117,3,transaction,11,99",
]


def test_batch_job_end_to_end(spark, tmp_path):
    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    res = run_batch_job(spark, [str(tmp_path / "missing.csv"), str(src)], str(tmp_path / "pq"), str(tmp_path / "csv"))
    assert res.input_path == str(src)
    assert res.total_events().first().total_events == 5
    top = [tuple(r) for r in res.tables["top_items"].collect()]
    assert top == [("10", 2), ("11", 1)]
    back = load_csv_results(spark, str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in back["event_distribution"].collect()) == [
        ("addtocart", 1), ("transaction", 1), ("view", 3)]
    view = batch_view(spark, str(tmp_path / "csv"))
    f = view["funnel"].first()
    assert (f.view_count, f.addtocart_count, f.transaction_count) == (3, 1, 1)
    assert view["date_window"].first().n_days == 2
    # one CSV file per bounded result
    published = Path(results_folder(spark, str(tmp_path / "csv")))
    parts = [p.name for p in (published / "top_items").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1


def test_batch_job_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_batch_job(spark, [str(tmp_path / "none.csv")], str(tmp_path / "pq"))


def test_batch_cli(spark, tmp_path, capsys):
    from eventflow.plans.batch import main

    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    main(["--input", str(src), "--parquet-out", str(tmp_path / "pq"), "--csv-out", str(tmp_path / "csv")])
    assert "total events: 5" in capsys.readouterr().out


def test_producer_replay_then_streaming_job(spark, tmp_path):
    from eventflow.plans.producer import csv_to_envelopes, replay_csv_to_files
    from eventflow.plans.streaming_job import run_streaming_job
    from eventflow.sources.files import read_archive
    from eventflow.streaming.sources import read_envelope_stream
    from eventflow.plans.dashboard import live_view, load_metric_table, load_stream_metric

    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    assert csv_to_envelopes(spark, str(src)).count() == 5
    replay_csv_to_files(spark, str(src), str(tmp_path / "env"))
    run_streaming_job(spark, read_envelope_stream(spark, str(tmp_path / "env")), str(tmp_path / "out"),
                      str(tmp_path / "ck"), available_now=True, snapshot=True, timeout_s=300)
    assert read_archive(spark, str(tmp_path / "out" / "raw-events")).count() == 5
    metric = load_stream_metric(spark, str(tmp_path / "out" / "snapshot" / "events_per_minute"))
    k = live_view(metric)["kpis"].first()
    assert k.total_events == 5 and k.event_types == 3
    # finalised windows only: the last event's window stays open under the watermark
    final = load_metric_table(spark, str(tmp_path / "out" / "events_per_minute"))
    assert live_view(final)["kpis"].first().total_events == 3


def test_one_bad_row_does_not_make_the_rest_late(spark, tmp_path):
    """An unreadable timestamp is put aside; the sliced replay of the other rows emits
    what the clean file emits."""
    from eventflow.plans.producer import publish_csv, replay_csv_to_files
    from eventflow.streaming import queries as sq
    from eventflow.functions.messages import parse_envelopes
    from eventflow.schemas import METRIC_SCHEMA
    from eventflow.streaming.sources import read_envelope_stream

    rows = [f"{1433221200000 + i * 7000},{i % 50},view,{i % 9}," for i in range(400)]
    rows += rows[100:140]  # equal timestamps
    found = []
    for name, bad in (("clean", []), ("bad", ["oops,1,view,2,", ",2,view,3,", "9223372036854775807,3,view,3,"])):
        src = tmp_path / f"{name}.csv"
        src.write_text(HEADER + "\n".join(rows[:200] + bad + rows[200:]) + "\n")
        env, out = str(tmp_path / f"{name}-env"), str(tmp_path / f"{name}-out")
        replay_csv_to_files(spark, str(src), env, slices=4, files_per_slice=2)
        metric = sq.metric_stream(parse_envelopes(read_envelope_stream(spark, env, max_files_per_trigger=2)))
        q = sq.start_metric_append(metric, out, str(tmp_path / f"{name}-ck"), trigger="availableNow")
        q.awaitTermination()
        dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
        assert dropped == 0
        found.append(sorted(tuple(r) for r in spark.read.schema(METRIC_SCHEMA).parquet(out).collect()))
        assert spark.read.text(f"{env}/_rejected").count() == len(bad)
    assert found[0] == found[1] and found[0]
    with pytest.raises(Exception, match="(?i)kafka"):  # no connector here, but the rows are kept aside first
        publish_csv(spark, str(src), "localhost:9", "events", rejected=str(tmp_path / "rejected"))
    assert spark.read.text(str(tmp_path / "rejected")).count() == 3


def test_a_wait_that_times_out_is_an_error(spark, tmp_path):
    from eventflow.plans.producer import replay_csv_to_files
    from eventflow.plans.streaming_job import run_streaming_job
    from eventflow.streaming.queries import stop_gracefully
    from eventflow.streaming.sources import read_envelope_stream

    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    replay_csv_to_files(spark, str(src), str(tmp_path / "env"))
    try:
        with pytest.raises(TimeoutError):
            run_streaming_job(spark, read_envelope_stream(spark, str(tmp_path / "env")), str(tmp_path / "out"),
                              str(tmp_path / "ck"), timeout_s=1)
    finally:
        stop_gracefully(spark.streams.active)


def test_all_days_are_printed(spark, tmp_path, capsys):
    from eventflow.plans import dashboard

    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(f"{1430640000000 + d * 86_400_000},{d},view,1," for d in range(139)) + "\n")
    run_batch_job(spark, str(src), str(tmp_path / "pq"), str(tmp_path / "csv"))
    capsys.readouterr()
    dashboard.main(["--batch", str(tmp_path / "csv")])
    assert capsys.readouterr().out.count("|2015-") >= 139


def test_stored_results_keep_their_order(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        src = tmp_path / "events.csv"
        src.write_text(HEADER + "\n".join(f"{1430640000000 + i},{i},e{i % 13},{i % 40}," for i in range(500)) + "\n")
        run_batch_job(spark, str(src), str(tmp_path / "pq"), str(tmp_path / "csv"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = sorted((Path(results_folder(spark, str(tmp_path / "csv"))) / "event_distribution").glob("part-*.csv"))
    counts = [int(line.split(",")[1]) for f in files for line in f.read_text().splitlines()[1:]]
    assert len(counts) == 13 and counts == sorted(counts, reverse=True)


def test_dataset_coverage_status(spark, tmp_path):
    from eventflow.plans.dashboard import dataset_coverage

    assert dataset_coverage(spark, str(tmp_path / "none.csv")).first().source == "missing"
    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    row = dataset_coverage(spark, str(src)).first()
    assert (row.n_events, row.source) == (5, "csv")
    empty = tmp_path / "empty.csv"
    empty.write_text(HEADER)
    assert dataset_coverage(spark, str(empty)).first().source == "empty"
    bad = tmp_path / "bad.csv"
    bad.write_text("event,timestamp,visitorid,itemid,transactionid\nview,1,2,3,\n")
    assert dataset_coverage(spark, str(bad)).first().source.startswith("error")


def test_batch_job_staged_equals_direct(spark, tmp_path):
    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    a = run_batch_job(spark, str(src), str(tmp_path / "a"), stage_csv=True, staged_path=str(tmp_path / "staged"))
    b = run_batch_job(spark, str(src), str(tmp_path / "b"), stage_csv=False)
    assert (tmp_path / "staged" / "_SUCCESS").exists()
    for name in a.tables:
        assert sorted(a.tables[name].collect()) == sorted(b.tables[name].collect())


def test_view_labels(spark, tmp_path):
    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    run_batch_job(spark, str(src), str(tmp_path / "pq"), str(tmp_path / "csv"))
    view = batch_view(spark, str(tmp_path / "csv"))
    labels = view["date_window_labels"].first()
    assert (labels.first_label, labels.last_label, labels.n_days) == ("Tuesday, 02 June 2015", "Wednesday, 03 June 2015", 2)


def test_live_labels(spark):
    from eventflow.plans.dashboard import live_view
    from tests.conftest import metric_rows

    m = metric_rows(spark, [("2015-06-02 05:00", "view", 2664312), ("2015-06-02 05:00", "addtocart", 69332),
                            ("2015-06-02 05:01", "transaction", 22457)])
    v = live_view(m)
    assert tuple(v["kpi_labels"].first()) == ("22,457", "2,756,101", "3")
    assert tuple(v["funnel_labels"].first()) == ("2.60 %", "32.39 %", "0.84 %")


def test_producer_and_dashboard_cli(spark, tmp_path, capsys):
    from eventflow.plans import dashboard, producer, streaming_job
    from eventflow.plans.batch import main as batch_main

    src = tmp_path / "events.csv"
    src.write_text(HEADER + "\n".join(ROWS) + "\n")
    producer.main(["--csv", str(src), "--envelopes", str(tmp_path / "env")])
    streaming_job.main(["--envelopes", str(tmp_path / "env"), "--out", str(tmp_path / "stream"),
                        "--checkpoints", str(tmp_path / "ck"), "--available-now", "--archive-by-date",
                        "--state-partitions", "2"])
    import os

    assert sorted(n for n in os.listdir(tmp_path / "stream" / "raw-events" / "kind=event") if n.startswith("event_date=")) == [
        "event_date=2015-06-02", "event_date=2015-06-03"]
    # the batch job replays the archive, one day of it
    day = run_batch_job(spark, str(tmp_path / "stream" / "raw-events"), str(tmp_path / "replay"),
                        input_format="archive", first_day="2015-06-03", last_day="2015-06-03")
    assert sorted(tuple(r) for r in day.tables["event_distribution"].collect()) == [("transaction", 1), ("view", 1)]
    batch_main(["--input", str(src), "--parquet-out", str(tmp_path / "pq"), "--csv-out", str(tmp_path / "csv")])
    capsys.readouterr()
    dashboard.main(["--metric-table", str(tmp_path / "stream" / "events_per_minute"),
                    "--batch", str(tmp_path / "csv"), "--events", str(src)])
    out = capsys.readouterr().out
    assert "== live: kpis" in out and "== batch: funnel" in out and "Tuesday, 02 June 2015" in out
    from eventflow.plans.dashboard import live_view, load_metric_table

    # finalised windows only: the last event's window stays open under the watermark
    table = load_metric_table(spark, str(tmp_path / "stream" / "events_per_minute"))
    assert live_view(table)["kpis"].first().total_events == 3
