import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.llm.queries import op5_toxicity
from eventflow.llm.toxicity import GRAMS, fit_toxicity, gradients, subwords, top_runs, toxicity_scores, train

SF = "/root/testdata/sf0.01"


def test_subwords_depend_on_the_word_alone():
    words = ["idiot", "a", "", "naïve", "idiots", "x" * 500, "😀"]
    flat, n = subwords(words, 1 << 17)
    at = np.cumsum(n)
    for i, w in enumerate(words):
        alone, k = subwords([w], 1 << 17)
        assert k[0] == n[i] and alone.tolist() == flat[at[i] - n[i] : at[i]].tolist()
        size = len(w) + 2
        assert n[i] == sum(max(0, size - g + 1) for g in (3, 4, 5, 6)) + 1
    shared = set(flat[at[0] - n[0] : at[0]]) & set(flat[at[4] - n[4] : at[4]])
    assert len(shared) > n[0] / 2  # "idiot" and "idiots"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(-5, 5), st.integers(1, 4)), max_size=9), min_size=1, max_size=5))
def test_top_runs_equal_brute_force(docs):
    value = np.array([v for d in docs for v, _ in d], float)
    count = np.array([c for d in docs for _, c in d], np.int64)
    best, begin, end = top_runs(value, count, np.array([len(d) for d in docs]), 4)
    at = 0
    for i, d in enumerate(docs):
        means = [sum(v for v, _ in d[k : k + 4]) / sum(c for _, c in d[k : k + 4]) for k in range(max(1, len(d) - 3)) if d]
        assert np.isclose(best[i], max(means, default=0.0))
        if d:
            assert at <= begin[i] < end[i] <= at + len(d)
        at += len(d)


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[y].mean() - (y.sum() - 1) / 2) / (~y).sum()


def test_insults_in_long_texts_and_misspellings():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("aeioulnrst"), rng.integers(2, 9))) for _ in range(400)]
    bad = ["moron", "stupid", "worthless"]

    def text(toxic, n):
        words = list(rng.choice(plain, n))
        if toxic:
            words[rng.integers(0, n)] = rng.choice(bad)
        return " ".join(words)

    y = np.arange(600) % 4 == 0
    model = train([text(t, int(rng.integers(5, 120))) for t in y], y, rounds=60)
    score = model.scorer()
    assert auc(score([text(t, 1500) for t in y]), y) > 0.95
    clean = score(["".join(w) for w in plain])
    for word in ("morron", "stuppid", "worthles", "MORONS"):
        assert score([" ".join(plain[:20] + [word])])[0] > np.quantile(clean, 0.95)


def test_held_out_accuracy_and_fold(spark):
    rows = op5_toxicity(spark, SF).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc(np.array([r["score"] for r in test]), np.array([labels[r["doc_id"]] == 1 for r in test])) > 0.85


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "x " * 100_000, 7), (3, "a", 8), (3, "a", 8)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 1")):
        model = fit_toxicity(docs, known)
        got = toxicity_scores(docs, model).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        by_id = {r["id"]: r["score"] for r in got}
        assert by_id[1] == by_id[2]
        assert toxicity_scores(docs.limit(0), model).collect() == []
    assert [r["id"] for r in toxicity_scores(docs.filter(F.col("doc_id") == 1), model).collect()] == [1]


def test_the_sample_is_whole_texts_within_its_bounds(spark, monkeypatch):
    got = {}
    monkeypatch.setattr("eventflow.llm.toxicity.train", lambda texts, labels: got.update(texts=texts, labels=labels.tolist()))
    docs = spark.createDataFrame([(i, None if i % 4 == 0 else "long " * 20 if i == 5 else f"text {i:03}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(160)], "doc_id long, toxic int")
    fit_toxicity(docs, labels, max_per_label=15)  # rows without a text are replaced
    assert sorted(got["labels"]) == [0] * 15 + [1] * 15 and None not in got["texts"]
    fit_toxicity(docs, labels, max_per_label=60, max_chars=100)  # 50 a label: what does not fit is passed over, nothing is cut
    assert sorted(got["labels"]) == [0] * 6 + [1] * 6 and all(len(t) == 8 for t in got["texts"])
    fit_toxicity(docs, labels, max_per_label=60)
    assert sorted(got["labels"]) == [0] * 30 + [1] * 30 and "long " * 20 in got["texts"]
    fit_toxicity(docs.unionByName(docs), labels, max_per_label=200)  # rows that share an id
    assert len(got["texts"]) == 120


def test_gradients_equal_differences_of_the_loss():
    rng = np.random.default_rng(2)
    params = [rng.normal(0, 0.5, (7, 3)), rng.normal(0, 0.5, (3, 2)), rng.normal(0, 0.5, 2)]
    bags, target, weight, decay = [[0, 1, 1, 4], [5], [2, 6, 0]], np.array([1, 0, 1]), np.array([0.5, 0.2, 0.3]), 0.01

    def loss():
        emb, out, bias = params
        total = decay / 2 * (np.square(emb).sum() + np.square(out).sum())
        for own, y, w in zip(bags, target, weight, strict=True):
            z = np.mean([emb[i] for i in own], axis=0) @ out + bias
            total += w * (np.log(np.exp(z).sum()) - z[y])
        return total

    sub = np.array([i for own in bags for i in own])
    bag = np.array([k for k, own in enumerate(bags) for _ in own])
    for param, grad in zip(params, gradients(params, sub, bag, len(bags), target, weight, decay), strict=True):
        for at in np.ndindex(param.shape):
            kept, step = param[at], 1e-5
            param[at] = kept + step
            above = loss()
            param[at] = kept - step
            below = loss()
            param[at] = kept
            assert np.isclose(grad[at], (above - below) / (2 * step), atol=1e-8)


def one_by_one(word, buckets):
    """A word's buckets, number by number."""
    full = (1 << 64) - 1
    code = [ord(c) for c in f"<{word}>"]
    hashes = []
    for n in GRAMS:
        for i in range(len(code) - n + 1):
            value = 0
            for k in range(n):
                value = ((value ^ (code[i + k] + 0x9E37)) * 0x100000001B3 + k + 1) & full
            hashes.append(value)
    hashes.append(sum(c * pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j, c in enumerate(code)) & full)
    return [((((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & full) >> 20) % buckets for h in hashes]


def test_scores_equal_plain_counting_of_every_run(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.01', '0.001')}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, " "), (-3, "ü😀 x")], "doc_id long, text string"))
    model = fit_toxicity(docs, labels)
    known = {}

    def word_of(w):
        if w not in known:
            own = one_by_one(w, len(model.weight))
            known[w] = (sum(model.weight[b] for b in own), len(own))
        return known[w]

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity_scores(docs, model).collect():
        words = [word_of(w) for w in (texts[r["id"]] or "").lower().split()]
        runs = [words[k : k + model.span] for k in range(max(1, len(words) - model.span + 1)) if words]
        best = max((sum(v for v, _ in run) / sum(n for _, n in run) for run in runs), default=0.0)
        margin = min(max(model.slope * (best + model.bias) + model.shift, -40), 40)
        assert np.isclose(r["score"], 1 / (1 + np.exp(-margin)), rtol=1e-6)
        assert r["predicted"] == (r["score"] >= 0.5)
