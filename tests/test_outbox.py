"""Publishing a stream of text rows: messages sent once, rejected rows kept as they came."""

import json
import time

import pytest

from eventflow.plans.producer import append_slices, read_events_text_stream, replay_csv_to_files, start_csv_publish_stream
from eventflow.sinks.files import write_parquet
from eventflow.streaming.control import run_to_end, run_with_restarts
from eventflow.streaming.outbox import OUTBOX_SCHEMA, read_outbox, rejected_rows, start_publish

HEADER = "timestamp,visitorid,event,itemid,transactionid\n"
FILES = [
    ["1433221332117,1,view,10,", "oops,2,view,,", ",3,addtocart,,"],
    ['1433221332118,,"a,b",11,7', "x,4", "99999999999999999999,5,view,1,2"],
    ["1433221332119,6,view"],
]


def _files(tmp_path, upto=len(FILES), first=0):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for k in range(first, upto):
        (folder / f"{k}.csv").write_text(HEADER + "\n".join(FILES[k]) + "\n")
        time.sleep(0.02)
    return str(folder)


def _sent(spark, path):
    rows = spark.read.schema("key binary, value binary").parquet(path).collect()
    return sorted((None if r.key is None else r.key.decode(), json.loads(r.value.decode())["timestamp"]) for r in rows)


SENT = [("", 1433221332118), ("1", 1433221332117), ("6", 1433221332119)]
REJECTED = [
    ("99999999999999999999", "5", "view", "1", "2"), ("", "3", "addtocart", "", ""), ("oops", "2", "view", "", ""), ("x", "4", None, None, None)]


def test_messages_and_rejected_rows(spark, tmp_path):
    src = _files(tmp_path)
    outbox, sent, ck = (str(tmp_path / n) for n in ("outbox", "sent", "ck"))
    assert read_outbox(spark, outbox).schema == OUTBOX_SCHEMA and rejected_rows(spark, outbox).collect() == []
    run_to_end(start_publish(read_events_text_stream(spark, src, 1), outbox, ck, lambda b: write_parquet(b, sent, mode="append"), "availableNow"))
    assert _sent(spark, sent) == SENT
    rows = rejected_rows(spark, outbox).collect()
    assert sorted((tuple(r)[1:] for r in rows), key=repr) == sorted(REJECTED, key=repr)
    assert {r.batch_id for r in rows} == {0, 1}
    message = next(json.loads(r.value) for r in read_outbox(spark, outbox).collect() if r.key == "1")
    assert (message["event"], message["itemid"], message["transactionid"]) == ("view", "10", None)


@pytest.mark.parametrize("fault", ["outbox", "send", "spark"])
def test_failures_send_nothing_twice(spark, tmp_path, fault):
    src = _files(tmp_path)
    outbox, sent, ck = (str(tmp_path / n) for n in ("outbox", "sent", "ck"))
    left = [1]

    def once(where):
        if fault == where and left:
            left.pop()
            raise OSError(where)

    def send(batch):
        once("send")
        write_parquet(batch, sent, mode="append")

    def wrap(write):
        def run(df, batch_id):
            if batch_id == 1:
                once("outbox")
            write(df, batch_id)
            if batch_id == 1:
                once("spark")  # sent and marked, but the batch is not committed

        return run

    failures = []
    run_with_restarts(lambda: start_publish(read_events_text_stream(spark, src, 1), outbox, ck, send, "availableNow", wrap), on_failure=failures.append)
    assert len(failures) == 1 and _sent(spark, sent) == SENT
    assert rejected_rows(spark, outbox).count() == len(REJECTED)


def test_without_a_broker_the_rows_are_kept(spark, tmp_path):
    """No Kafka connector here: the batch fails, but what it would have sent is stored."""
    src, ck = _files(tmp_path), str(tmp_path / "ck")
    query = start_csv_publish_stream(spark, src, "localhost:9", "events", ck, trigger="availableNow")
    with pytest.raises(Exception, match="kafka"):
        query.awaitTermination()
    assert read_outbox(spark, f"{ck}-outbox").count() == len(SENT) + len(REJECTED)


def test_slices_fill_exactly_their_files(spark, tmp_path):
    src, out = tmp_path / "e.csv", str(tmp_path / "env")
    src.write_text(HEADER + "".join(f"{1433221332000 + i},1,view,10,\n" for i in range(9)))
    replay_csv_to_files(spark, str(src), out, slices=3, files_per_slice=8)
    names = [p for p in (tmp_path / "env").iterdir() if p.name.startswith("part-")]
    assert len(names) == 24 and spark.read.parquet(out).count() == 9
    append_slices(spark, str(tmp_path / "none"), out, 3, 8)  # no slices: nothing is added
    assert len([p for p in (tmp_path / "env").iterdir() if p.name.startswith("part-")]) == 24
