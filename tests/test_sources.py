import pytest

from eventflow.schemas import TOP_ITEMS_SCHEMA, DAILY_VISITORS_SCHEMA, METRIC_SCHEMA
from eventflow.sources.files import read_events_csv, read_result_folder, resolve_input
from eventflow.sinks.files import write_csv


def _csv(tmp_path, text, name="events.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


HEADER = "timestamp,visitorid,event,itemid,transactionid\n"


def test_csv_permissive_rows(spark, tmp_path):
    path = _csv(
        tmp_path,
        HEADER
        + 'bad,1,view,2,""\n'  # bad long -> NULL, row kept
        + "1433224214164,992329,view\n"  # short row
        + "1433224214164,5,transaction,7,44,extra\n"  # long row
        + "1433224214165,,view,3,\n",  # empty -> NULL
    )
    rows = read_events_csv(spark, path).collect()
    assert len(rows) == 4
    assert rows[0].timestamp is None and rows[0].transactionid is None and rows[0].event == "view"
    assert rows[1].itemid is None and rows[1].transactionid is None
    assert rows[2].transactionid == "44"
    assert rows[3].visitorid is None and rows[3].transactionid is None


def test_csv_reordered_header_fails(spark, tmp_path):
    path = _csv(tmp_path, "event,timestamp,visitorid,itemid,transactionid\nview,1,2,3,\n")
    with pytest.raises(Exception):
        read_events_csv(spark, path).collect()


def test_csv_prunes_columns(spark, tmp_path):
    path = _csv(tmp_path, HEADER + "1,2,view,3,\n")
    plan = read_events_csv(spark, path).select("timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp:bigint>" in plan


def test_result_folder_missing_or_empty(spark, tmp_path):
    df = read_result_folder(spark, str(tmp_path / "nope"), TOP_ITEMS_SCHEMA)
    assert df.schema == TOP_ITEMS_SCHEMA and df.count() == 0
    (tmp_path / "empty").mkdir()
    df = read_result_folder(spark, str(tmp_path / "empty"), TOP_ITEMS_SCHEMA)
    assert df.count() == 0


def test_result_folder_roundtrip_and_lenient_types(spark, tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    (folder / "part-00000.csv").write_text("event_date,active_visitors\n2015-06-02,3\nnot-a-date,x\n")
    (folder / "part-00001.csv").write_text("event_date,active_visitors\n2015-06-03,4\n")
    (folder / "_SUCCESS").write_text("")
    rows = sorted(read_result_folder(spark, str(folder), DAILY_VISITORS_SCHEMA).collect(), key=str)
    assert len(rows) == 3
    assert {str(r.event_date) for r in rows} == {"2015-06-02", "2015-06-03", "None"}


def test_metric_csv_roundtrip_keeps_instants(spark, tmp_path, la_zone):
    from tests.conftest import metric_rows

    m = metric_rows(spark, [("2015-06-02 05:00", "view", 3)])
    write_csv(m, str(tmp_path / "m"))
    back = read_result_folder(spark, str(tmp_path / "m"), METRIC_SCHEMA)
    assert back.collect() == m.collect()


def test_resolve_input(spark, tmp_path):
    there = _csv(tmp_path, HEADER)
    assert resolve_input(spark, [str(tmp_path / "missing.csv"), there]) == there
    with pytest.raises(FileNotFoundError):
        resolve_input(spark, [str(tmp_path / "missing.csv"), str(tmp_path / "neither.csv")])
    with pytest.raises(Exception, match="nosuchscheme"):  # an unreachable store is not "not there"
        resolve_input(spark, ["nosuchscheme://host/x.csv", there])


def test_result_folder_with_another_header_or_broken_file_fails(spark, tmp_path):
    from eventflow.schemas import EVENT_DISTRIBUTION_SCHEMA

    d = tmp_path / "res"
    d.mkdir()
    (d / "part-0.csv").write_text("count,event\n5,view\n")
    with pytest.raises(Exception):
        read_result_folder(spark, str(d), EVENT_DISTRIBUTION_SCHEMA).collect()


def test_text_reader_tells_empty_from_missing(spark, tmp_path):
    from eventflow.plans.producer import read_events_text

    src = tmp_path / "e.csv"
    src.write_text('timestamp,visitorid,event,itemid,transactionid\n1,,"",i,\n2,v\n3,v,"a,b"\n4,v,e,i,t,more\n')
    rows = {r.timestamp: tuple(r)[1:] for r in read_events_text(spark, str(src)).collect()}
    assert rows["1"] == ("", "", "i", "")
    assert rows["2"] == ("v", None, None, None)
    assert rows["3"] == ("v", "a,b", None, None)
    assert rows["4"] == ("v", "e", "i", "t")


def test_archive_without_dates_refuses_a_range(spark, tmp_path):
    from eventflow.schemas import MESSAGE_SCHEMA
    from eventflow.sources.files import read_archive

    spark.createDataFrame([], MESSAGE_SCHEMA).write.parquet(str(tmp_path / "a"))
    with pytest.raises(ValueError, match="event_date"):
        read_archive(spark, str(tmp_path / "a"), "2015-06-02")
