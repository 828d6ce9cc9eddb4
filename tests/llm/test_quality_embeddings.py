import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import quality_embeddings as qe
from eventflow.llm.queries import op12_quality_classifier


def naive_features(text, buckets):
    """Plain recount of a text's features: {bucket: how often}."""
    words = text.split()
    out = {}
    for w in words:
        flat, n, _ = qe.word_grams([w], buckets)
        assert int(n[0]) == 1 + sum(max(len(w) + 2 - size + 1, 0) for size in qe.SIZES)
        for b in flat.tolist():
            out[b] = out.get(b, 0) + 1
    for a, b in zip(words, words[1:], strict=False):
        hashes = np.concatenate([qe.word_grams([a], buckets)[2], qe.word_grams([b], buckets)[2]])
        pair, _ = qe.pair_buckets(hashes, np.array([2]), buckets)
        out[int(pair[0])] = out.get(int(pair[0]), 0) + 1
    return out


TEXTS = ["one two  two\nthree", "", "ÄÖ ß x", "word " * 50, "a", "tail tail end", "\U0001f600 smile"]


def test_bags_and_scores_equal_a_plain_recount():
    buckets = 1 << 12
    rng = np.random.default_rng(3)
    model = qe.QualityModel(rng.normal(0, 1, buckets), 0.3, 0.4)
    plain = [naive_features(t, buckets) for t in TEXTS]
    for (bucket, share), own in zip(qe.bags(TEXTS, buckets), plain, strict=True):
        total = sum(own.values())
        assert dict(zip(bucket.tolist(), share.tolist(), strict=True)) == {b: np.float32(n / total) for b, n in own.items()}
    expected = [
        1 / (1 + np.exp(-(sum(model.weight[b] * n for b, n in own.items()) / sum(own.values()) + 0.3))) if own else 0.4 for own in plain]
    score = model.scorer()
    assert np.allclose(score(TEXTS), expected) and np.allclose(score(TEXTS[::-1]), expected[::-1])
    forgetful = qe.QualityModel(model.weight, 0.3, 0.4, remember=1).scorer()
    assert np.allclose([forgetful([t])[0] for t in TEXTS], expected)


def test_more_steps_lower_the_loss():
    texts, labels = ["good clean prose", "BAD!! BAD!! JUNK$$"], [1, 0]

    def loss(m):
        s = m.scorer()(texts)
        return -np.mean([np.log(s[0]), np.log(1 - s[1])])

    losses = [loss(qe.train(texts, labels, buckets=1 << 10, epochs=e, rate=0.5)) for e in (1, 5, 25)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.1


def test_unseen_words_share_grams():
    rng = random.Random(5)
    stems = ["lamp", "river", "garden", "window", "table"]

    def word():
        return rng.choice(stems) + rng.choice(["ing", "ed", "s", "er", "ly"])

    good = [" ".join(word() for _ in range(40)) for _ in range(150)]
    bad = [" ".join(word() + "$$$" for _ in range(40)) for _ in range(150)]
    model = qe.train(good + bad, [1] * 150 + [0] * 150, buckets=1 << 14)
    s = model.scorer()(["mountainous plains rolling", "mountainous$$$ plains$$$ rolling$$$"])
    assert s[0] > 0.5 > s[1]
    repeats = qe.train(good + ["lamp " * 40, "river " * 60, "table " * 30] * 50, [1] * 150 + [0] * 150, buckets=1 << 14)
    assert repeats.scorer()(["unseenword " * 30])[0] < 0.5


def test_sample_is_bounded_and_holds_whole_texts(spark):
    docs = [(i, ("x" * 100 + " ") * (i % 3 + 1)) for i in range(40)] + [(100, None), (101, "y" * 5000), (1, "second row of 1")]
    labels = [(i, i % 2) for i in range(40)] + [(1, 0), (100, 1), (101, 1), (None, 1), (7, None), (999, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    seen = []
    real, qe.train = qe.train, lambda texts, y: seen.append((texts, list(y)))
    try:
        for rows, chars in ((4000, 10**7), (10, 10**7), (4000, 1000)):
            qe.fit_quality_embeddings(d, lab, max_rows=rows, max_chars=chars)
    finally:
        qe.train = real
    whole = {t for _, t in docs if t}
    assert len(seen[0][0]) == 42 and len(seen[1][0]) == 10 and sum(map(len, seen[2][0])) <= 1000
    assert all(set(texts) <= whole for texts, _ in seen)


def test_edges(spark):
    model = qe.train([], [])
    rows = [(1, None), (2, ""), (2, ""), (None, " \n"), (3, "word " * 200_000)]
    d = spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], "doc_id long, text string, score double, predicted int")
    out = qe.quality_scores(d, model).collect()
    assert len(out) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in out)
    assert qe.quality_scores(d.limit(0), model).collect() == []
    one = qe.train(["only good"] * 8, [1] * 8)
    assert one.scorer()(["anything", ""]).tolist() == pytest.approx([0.9, 0.9])
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert qe.quality_scores(d, qe.fit_quality_embeddings(d, empty)).count() == 5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    out = op12_quality_classifier(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.filter("held_out").join(truth, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows) and len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert out.filter(F.col("score").between(0, 1)).count() == out.count()
