import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from eventflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SCHEMA = "doc_id long, text string, group_size string, H string"
ROWS = [
    (1, "a", "x", "x"), (2, "a", None, "y"), (3, "b", "x", None), (4, None, None, None), (5, "", "z", "z"),
    (None, "a", None, None), (None, "q", None, None), (None, "q", None, None), (7, "a ", "x", "x"),
    (8, "long " * 50_000, None, None), (9, "long " * 50_000, None, None), (9, "long " * 50_000, None, None),
]


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "max" else min)(known) if known else None
        for i in ids:
            out.append((i, best, len(ids), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def check(got, rows, keep):
    assert sorted([(r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == brute(rows, keep)
    kept = defaultdict(int)
    for r in got:
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["id"] == r["keep_id"]
    assert set(kept.values()) == {1}


def test_groups_nulls_ties_and_long_texts(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for keep in ("min", "max"):
        check(exact_duplicates(docs, keep=keep).collect(), ROWS, keep)


def test_collisions_are_told_apart_by_their_bytes(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_duplicates(docs, hash_fn=lambda t: F.length(t) % 2).collect()
    check(got, ROWS, "min")


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_drop_keeps_one_row_of_each_text(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    got = sorted([(r["doc_id"], (r["text"] or "")[:6]) for r in out.collect()], key=str)
    assert got == sorted([(1, "a"), (3, "b"), (4, ""), (None, "q"), (7, "a "), (8, "long l")], key=str)
