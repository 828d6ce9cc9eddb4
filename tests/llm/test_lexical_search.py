import math
import re
from collections import Counter

import pytest

from eventflow.llm.lexical_search import item_blocks, item_terms, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """docs: [(id, text)], items: [(id, text)] -> {item: [(rank, doc, score)]}"""
    own = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in own if c)
    n_terms = sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(terms(t))
    out = {}
    for item, query in wanted.items():
        found = []
        for i, c in own:
            if not c:
                continue
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in query if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out[item] = [(rank, row[3], -row[0]) for rank, row in enumerate(sorted(found)[:k], 1)]
    return {i: r for i, r in out.items() if r}


def ranked(df):
    out = {}
    for r in df.orderBy("item_id", "rank").collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return out


DOCS = [
    (5, "The quick brown fox; the lazy dog"), (3, "quick QUICK Quick-quick\tbrown"), (9, "the the the the"), (2, None), (4, ""), (6, " \n\t .,!"),
    (7, "straße Ünder naïve 日本語 x" * 1), (8, "STRASSE ünder  glued  x1 1x"), (1, "brown fox"), (10, "brown fox"), (10, "brown fox"), (None, "brown dog"),
    (11, "foxes brownfox fox" + " filler word" * 4000 + " fox\x00fox"), (12, "under the Ünder"), (13, "x" * 30_000 + " fox"),
]
ITEMS = [
    (1, "quick brown fox"), (2, "the the fox THE"), (3, "Ünder 日本語"), (4, None), (5, " .. "), (6, "unknownterm"), (None, "dog lazy"),
    (7, " glued  x1"), (2, "fox dog"), (8, "x"),
]


@pytest.mark.parametrize("max_postings", [500_000, 4, 1])
def test_equals_brute_force(spark, max_postings):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for k in (20, 2):
        assert ranked(search(docs, items, k=k, max_postings=max_postings, salts=3)) == brute(DOCS, ITEMS, k)


def test_extra_columns_text_ids_and_ties(spark):
    docs = [(f"d{i:02d}", "same words here" if i % 2 else "other words") for i in range(60)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id string, text string, score int, item int").repartition(7)
    items = spark.createDataFrame([("q", "same here", 9)], "item_id string, text string, rank int")
    rows = search(frame, items, k=5).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == ["d01", "d03", "d05", "d07", "d09"]
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5] and len({r.score for r in rows}) == 1


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search(docs.limit(0), items).collect() == []
    assert search(docs, items.limit(0)).collect() == []
    assert search(docs, items.filter("item_id = 4")).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_hold_every_posting_once(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i * j % 97}" for j in range(9))) for i in range(50)], "item_id long, text string")
    postings = item_terms(items)
    blocks = item_blocks(postings, 40)
    rows = [(r["item"], r["term"]) for b in blocks for r in b.collect()]
    assert len(blocks) > 1 and sorted(rows) == sorted((r["item"], r["term"]) for r in postings.collect())
    assert all(b.count() <= 40 for b in blocks)


def test_scores_beyond_doubles_stay_whole(spark):
    # repeats so many that sums pass 2^53: the integer path
    docs = [(i, "a b" if i else "b") for i in range(4)]
    text = "a " * 1_500_000
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert ranked(search(frame, items)) == brute(docs, [(1, text)])
