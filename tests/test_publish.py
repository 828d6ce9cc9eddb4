"""One commit publishes all results of a run, or none."""

import json

import pytest

from eventflow.plans.batch import RESULT_NAMES, load_csv_results, load_parquet_results, run_batch_job
from eventflow.sinks import publish as pub
from eventflow.sources.files import create_text, list_children, path_exists, read_text

HEADER = "timestamp,visitorid,event,itemid,transactionid\n"


def _input(tmp_path, name, rows):
    src = tmp_path / f"{name}.csv"
    src.write_text(HEADER + "".join(f"143322133211{i % 10},{i},view,{item},\n" for i, item in enumerate(rows)))
    return str(src)


def _state(spark, pq, csv):
    return {fmt: {n: sorted(map(tuple, t[n].collect()), key=repr) for n in RESULT_NAMES}
            for fmt, t in (("pq", load_parquet_results(spark, pq)), ("csv", load_csv_results(spark, csv)))}


class Killed(BaseException):
    """Not an ``Exception``: like a signal, nothing below is meant to handle it."""


@pytest.mark.parametrize("killed_at", RESULT_NAMES)
def test_a_run_that_dies_between_results_changes_nothing(spark, tmp_path, killed_at):
    pq, csv = str(tmp_path / "pq"), str(tmp_path / "csv")
    run_batch_job(spark, _input(tmp_path, "old", ["a", "a", "b"]), pq, csv)
    before = _state(spark, pq, csv)
    assert before["pq"]["top_items"] == before["csv"]["top_items"] == [("a", 2), ("b", 1)]

    def die(name):
        if name == killed_at:
            raise Killed(name)

    new = _input(tmp_path, "new", ["c"] * 5)
    with pytest.raises(Killed):
        run_batch_job(spark, new, pq, csv, on_stored=die)
    assert _state(spark, pq, csv) == before
    run_batch_job(spark, new, pq, csv)
    after = _state(spark, pq, csv)
    assert after["pq"]["top_items"] == after["csv"]["top_items"] == [("c", 5)]


def test_a_reader_keeps_its_run_while_the_next_is_published(spark, tmp_path):
    pq = str(tmp_path / "pq")
    run_batch_job(spark, _input(tmp_path, "one", ["a"]), pq)
    held = load_parquet_results(spark, pq)["top_items"]
    run_batch_job(spark, _input(tmp_path, "two", ["b"]), pq)
    assert [r.itemid for r in held.collect()] == ["a"]  # keep_runs=2
    assert [r.itemid for r in load_parquet_results(spark, pq)["top_items"].collect()] == ["b"]
    run_batch_job(spark, _input(tmp_path, "three", ["c"]), pq)
    runs = [n for n, d in list_children(spark, pq) if d and n.startswith("run=")]
    assert len(runs) == 2 and len(pub.commits(spark, pq)) == 2


def test_commits_are_exclusive_and_a_torn_one_is_passed_over(spark, tmp_path):
    log = str(tmp_path / "log")
    assert pub.committed_folder(spark, log) is None and pub.results_folder(spark, log) == log
    first = pub.commit_run(spark, log, "r1", {"parquet": log})
    assert create_text(spark, f"{log}/_commits/{first.number + 1:012d}.json", '{"run": "r2", "pla')  # its writer died
    assert pub.committed_folder(spark, log) == f"{log}/run=r1"
    third = pub.commit_run(spark, log, "r3", {"parquet": log})
    assert third.number == 2 and pub.committed_folder(spark, log) == f"{log}/run=r3"
    assert not create_text(spark, f"{log}/_commits/{third.number:012d}.json", "other")
    assert json.loads(read_text(spark, f"{log}/_commits/{third.number:012d}.json"))["run"] == "r3"


def test_pointer_moves_with_the_commit(spark, tmp_path):
    a, b, csv = (str(tmp_path / n) for n in ("a", "b", "csv"))
    pub.commit_run(spark, a, "r1", {"parquet": a, "csv": csv})
    assert pub.committed_folder(spark, csv) == f"{csv}/run=r1"
    pub.commit_run(spark, b, "r2", {"parquet": b, "csv": csv})
    assert pub.committed_folder(spark, csv) == f"{csv}/run=r2" and pub.committed_folder(spark, a) == f"{a}/run=r1"


def test_leftovers_of_killed_runs(spark, tmp_path):
    base = str(tmp_path / "base")
    pub.commit_run(spark, base, "20200101T000000-aaaaaaaaaaaa", {"parquet": base})
    for run in ("20200101T000000-aaaaaaaaaaaa", "20200102T000000-bbbbbbbbbbbb", pub.new_run()):
        create_text(spark, f"{pub.run_folder(base, run)}/x", "")
    assert pub.drop_unpublished(spark, base) == ["20200102T000000-bbbbbbbbbbbb"]
    assert path_exists(spark, pub.run_folder(base, "20200101T000000-aaaaaaaaaaaa"))


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    folder = tmp_path / "plain" / "top_items"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("itemid,view_count\nx,3\n")
    found = load_csv_results(spark, str(tmp_path / "plain"))
    assert [tuple(r) for r in found["top_items"].collect()] == [("x", 3)] and found["daily_visitors"].collect() == []
