import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm.quality import FALLING, FEATURES, fit_quality, fit_trees, keep_quality, quality_verdicts, statistics
from eventflow.llm.queries import op9_quality_rules
from tests.conftest import SF_SMALL

TEXTS = ["", None, " \t\n", "a b c a b c", "a a a a a", "a b c d", "x\ny\nx\n\nx \n \n", "#*$ %&| <> #", "a\x0bb\x0cc\rd",
         "é ü x　y", "one two three " * 4000, "A1, B2. C3!! | D"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")) if words else 0, dup, len(covered))


def test_statistics_equal_brute_force(spark):
    docs = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    for texts in (TEXTS, docs):
        counts, x = statistics(texts)
        assert list(map(tuple, counts.tolist())) == [brute(t) for t in texts]
        assert np.isfinite(x).all()


def test_trees_score_as_one_by_one_and_keep_their_constraints():
    rng = np.random.default_rng(3)
    x = rng.random((600, len(FEATURES)))
    y = ((x[:, 0] > 0.4) & (x[:, FEATURES.index("symbols_per_word")] < 0.6) ^ (rng.random(600) < 0.05)).astype(float)
    trees = fit_trees(x, y, rounds=20)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.9

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.feature[node] >= 0:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.margin(x[:50]), [walk(r) for r in x[:50]])
    for name in FALLING:
        grid = np.repeat(x[:40], 30, axis=0)
        grid[:, FEATURES.index(name)] = np.tile(np.linspace(0, 1, 30), 40)
        assert (np.diff(trees.margin(grid).reshape(40, 30), axis=1) <= 1e-12).all()


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, 0), (None, 1, 0)]])
def test_without_usable_labels_only_the_base_rules_decide(spark, labels):
    docs = spark.createDataFrame([(1, "w " * 5, "x"), (2, " ".join(map(str, range(60))), None), (2, None, "x")],
                                 "doc_id long, text string, kept string")
    trees = fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = sorted((r["id"], r["n_words"], r["base_failed"], r["kept"]) for r in quality_verdicts(docs, trees).collect())
    assert got == [(1, 5, True, False), (2, 0, True, False), (2, 60, False, True)]
    assert keep_quality(docs, trees).columns == docs.columns
    assert [tuple(r)[0::2] for r in keep_quality(docs, trees).collect()] == [(2, None)]
    assert quality_verdicts(docs.limit(0), trees).collect() == []


def test_held_out_accuracy(spark):
    base = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    trees = fit_quality(docs, labels.filter("doc_id % 3 > 0"))
    truth = labels.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), F.col("quality").alias("good"))
    rows = quality_verdicts(docs, trees).join(truth, "id").collect()
    right = [(r["quality"] >= 0.5) == (r["good"] == 1) for r in rows]
    assert len(right) > 100 and np.mean(right) > 0.97


def brute_features(text):
    n, chars, symbols, dup, repeat = brute(text)
    if not n:
        return [0.0] * len(FEATURES)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    filled = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in text.split("\n"))

    def times(chars):
        return len(re.findall(f"[{chars}]", text))

    return [np.log1p(n), chars / n, len(set(words)) / n, n / filled, times("A-Z") / chars, times("0-9") / chars, times(",.") / n,
            symbols / n, times("!") / n, times("|") / n, dup / filled, repeat / n]


def test_whole_verdict_equals_walking_the_trees(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    trees = fit_quality(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = op9_quality_rules(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text, margin = texts[r["doc_id"]], trees.base
        x = brute_features(text)
        for node in trees.roots:
            while trees.feature[node] >= 0:
                node = trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            margin += trees.value[node]
        counts = brute(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == failed and np.isclose(r["quality"], 1 / (1 + np.exp(-margin)))
        assert r["kept"] == (not failed and margin >= 0)
    assert 0 < sum(r["kept"] for r in rows) < len(rows)
