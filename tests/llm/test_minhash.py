import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm.components import components
from eventflow.llm.minhash import NearDuplicates, bands_for, least_matches, near_duplicates, shingle_sets, signatures
from tests.conftest import SF_SMALL


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def classes(items, links):
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def brute(docs, width, pct):
    sets = {i: shingles(t, width) for i, t in docs}
    links = [(a, b) for (a, x), (b, y) in combinations(sets.items(), 2) if x and y and 100 * len(x & y) >= pct * len(x | y)]
    return {i: (len(sets[i]), c, i == c) for i, c in classes(sets, links).items()}


def result(df, **kw):
    return {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df, **kw).collect()}


def test_shingles_and_signatures():
    texts = ["", None, "a", "A b", "a B c d", "É é Ä", "x\x0by\x0cz\r1\t2\n3 4", "a　b c d"]
    for width in (3, 5):
        assert [len(s) for s in shingle_sets(texts, width)] == [len(shingles(t, width)) for t in texts]
    a, b = shingle_sets(["x Y z", "X y Z"], 3)
    assert (a == b).all()
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000, np.uint64)
    sig = signatures([x, np.concatenate([x[:850], x[:75] + np.uint64(1)])], 2000)
    assert abs((sig[0] == sig[1]).mean() - 850 / 1075) < 0.05


def test_bounds():
    for t in (0.8, 0.85):
        bands, rows = bands_for(t, 1e-7)
        assert (1 - t**rows) ** bands <= 1e-7 and bands * rows <= 160
        need = least_matches(t, 1e-7, bands * rows)
        # a pair at the threshold passes each decision with a probability near 1
        rng = np.random.default_rng(0)
        agree = rng.random((20_000, bands * rows)) < t
        assert all((agree[:, :n].sum(1) >= m).all() for n, m in need.items())


@pytest.mark.parametrize("width, pct", [(3, 85), (5, 80)])
def test_documents_equal_brute_force(spark, width, pct):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert result(df, width=width, least_pct=pct) == brute(docs, width, pct)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_groups_of_near_copies_in_small_blocks(spark):
    # similarities on both sides of the threshold, chains, and groups larger than a block
    rng = random.Random(5)
    docs = [t for _ in range(6) for t in family(rng, 30, 60, 4)] + [t for t in family(rng, 60, 200, 12)]
    rng.shuffle(docs)
    docs = list(enumerate(docs + docs[:5]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for block in (4, 512):
        assert result(df, width=3, least_pct=85, block=block) == brute(docs, 3, 85)


def test_a_link_between_members_that_are_far_from_the_leader(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(100)]
    chain = [" ".join(words[:100 - 0] + [f"x{k}_{i}" for i in range(0)]) for k in range(1)]
    for k in range(1, 25):  # each step replaces one more word: neighbours are near, ends are far
        words[rng.randrange(100)] = f"s{k}"
        chain.append(" ".join(words))
    docs = list(enumerate(chain))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(df, width=3, least_pct=85, block=3) == brute(docs, 3, 85)


def test_edge_cases(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \n", 3), (4, "a b", 4), (4, "a b", 4), (None, "a b", 5), (None, "q r", 6), (5, "A  B", 7),
            (6, "long " * 40_000, 8), (7, "long " * 40_000 + "x", 9), (8, "c d e f", 10), (8, "g h i j", 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (None, 1, 4, False),
        (None, 1, None, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True), (8, 1, 8, True), (8, 1, 8, True)], key=str)
    assert near_duplicates(df.limit(0)).collect() == []


def test_links_are_pairs_of_nodes(spark):
    docs = [(1, "a b c d e f g h i j k l"), (2, "a b c d e f g h i j k l m"), (3, "z y x")]
    job = NearDuplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=3, least_pct=85)
    ids = {r["node"]: r["id"] for r in job.nodes.collect()}
    assert [{ids[r["a"]], ids[r["b"]]} for r in job.links().collect()] == [{1, 2}]


def test_components_equal_brute_force(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    df = spark.createDataFrame([rng.choice([(a, b), (b, a)]) for a, b in links] + [(5, 5)], "x long, y long")
    got = {r["node"]: r["component"] for r in components(df, "x", "y").collect()}
    want = classes({i for link in links if link[0] != link[1] for i in link}, links)
    assert got == want
    assert components(df.filter(F.lit(False)), "x", "y").collect() == []


def test_rows_without_ids_do_not_all_meet(spark):
    """The texts of rows without an id are found one by one, not each by every row."""
    docs = spark.range(20_000).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.concat_ws(" ", *[F.concat(F.lit(w), F.floor(F.col("id") / 2)) for w in "abcdefghijklmnopqrst"],
                    F.concat(F.lit("end"), F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("id").cast("string")))).alias("text"))
    work = NearDuplicates(docs, width=3, least_pct=85)
    wanted = work.nodes.select("node")
    assert wanted.count() == 20_000
    sets = work._sets(wanted)
    assert sets.count() == 20_000
    assert work.links().count() == 10_000
