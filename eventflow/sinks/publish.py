"""All-or-nothing publishing of a set of results.

A run writes its results into a folder of its own, ``<base>/run=<id>``, where no reader
looks.  It is published by one small file in ``<log>/_commits``, numbered, created
exclusively and naming the run and every base it wrote to.  Readers take the newest whole
commit and read its run's folders: they see all results of one run or all of another,
in every format, whenever a run is killed.  A commit cut short does not parse and is
passed over.

A base other than the log's own (the CSV copy beside the parquet results) holds a pointer
to the log, so that one commit covers both.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession

from eventflow.sources.files import create_text, delete_path, list_children, read_text

COMMITS, POINTER, RUN = "_commits", "_commit_log", "run="
STAMP = "%Y%m%dT%H%M%S"


def new_run() -> str:
    """An id that sorts by the time of the run's start and is never used twice."""
    return f"{datetime.now(UTC).strftime(STAMP)}-{uuid.uuid4().hex[:12]}"


def run_folder(base: str, run: str) -> str:
    return f"{base.rstrip('/')}/{RUN}{run}"


@dataclass(frozen=True)
class Commit:
    number: int
    run: str
    places: dict[str, str] = field(default_factory=dict)


def commits(spark: SparkSession, log: str) -> list[Commit]:
    """Whole commits of a log, oldest first."""
    found = []
    for name, is_dir in sorted(list_children(spark, f"{log.rstrip('/')}/{COMMITS}")):
        if is_dir or not name.endswith(".json") or not name[:-5].isdigit():
            continue
        try:
            body = json.loads(read_text(spark, f"{log.rstrip('/')}/{COMMITS}/{name}"))
            found.append(Commit(int(name[:-5]), body["run"], body["places"]))
        except (ValueError, KeyError):  # its writer was killed
            continue
    return found


def commit_run(spark: SparkSession, log: str, run: str, places: dict[str, str], keep: int = 2) -> Commit:
    """Publish ``run`` (``places``: name of a base -> the base) and delete the runs before
    the newest ``keep``, which readers may still be reading.  Of two runs that commit at
    once, the second to create its file is the newer one."""
    log = log.rstrip("/")
    numbers = [int(n[:-5]) for n, _ in list_children(spark, f"{log}/{COMMITS}") if n.endswith(".json") and n[:-5].isdigit()]
    number = max(numbers, default=-1) + 1
    body = json.dumps({"run": run, "places": {name: base.rstrip("/") for name, base in places.items()}})
    while not create_text(spark, f"{log}/{COMMITS}/{number:012d}.json", body):
        number += 1
    for name, base in places.items():
        if base.rstrip("/") != log:  # after the commit: until then the base follows its old log
            create_text(spark, f"{base.rstrip('/')}/{POINTER}", json.dumps({"log": log, "place": name}), overwrite=True)
    if keep > 0:
        for old in commits(spark, log)[:-keep]:
            delete_path(spark, f"{log}/{COMMITS}/{old.number:012d}.json")
            for base in old.places.values():
                delete_path(spark, run_folder(base, old.run))
    return Commit(number, run, json.loads(body)["places"])


def committed_folder(spark: SparkSession, base: str) -> str | None:
    """The folder of the published run under ``base``; None if nothing was published."""
    base = base.rstrip("/")
    log, place = base, None
    if any(name == POINTER for name, _ in list_children(spark, base)):
        pointer = json.loads(read_text(spark, f"{base}/{POINTER}"))
        log, place = pointer["log"], pointer["place"]
    done = [c for c in commits(spark, log) if place is None or place in c.places]
    return run_folder(base, done[-1].run) if done else None


def results_folder(spark: SparkSession, base: str) -> str:
    """Where to read results of ``base``: the published run, or ``base`` itself for a plain
    folder of results written without commits."""
    return committed_folder(spark, base) or base.rstrip("/")


def drop_unpublished(spark: SparkSession, base: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete what killed runs left under ``base``: run folders that no commit names and
    whose run began more than ``older_than_hours`` ago (a younger one may be at work)."""
    base = base.rstrip("/")
    folder = committed_folder(spark, base)
    log = base
    if any(name == POINTER for name, _ in list_children(spark, base)):
        log = json.loads(read_text(spark, f"{base}/{POINTER}"))["log"]
    named = {c.run for c in commits(spark, log)}
    before = (datetime.now(UTC) - timedelta(hours=older_than_hours)).strftime(STAMP)
    dropped = []
    for name, is_dir in list_children(spark, base):
        run = name.removeprefix(RUN)
        if is_dir and name.startswith(RUN) and run not in named and run[:15] < before and f"{base}/{name}" != folder:
            delete_path(spark, f"{base}/{name}")
            dropped.append(run)
    return dropped
