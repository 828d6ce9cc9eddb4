"""Quality classifier: averaged embeddings of hashed words and character n-grams under a
softmax.

A document is a bag of words, each with its character n-grams (3 to 5, word borders
included, case kept) and of pairs of neighbouring words (all immediate repetitions share
one).  Every one is hashed to one of ``buckets`` vectors; the document's vector is the
mean of them all and a softmax of two classes is its output.  Vectors and output are
learnt together by stochastic gradient descent in numpy, one document a step, on a bounded
sample in its natural mix, so scores are probabilities.

The mean is linear, so scoring a whole text takes one learnt number per word (kept by the
worker) and per pair, and no vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import by_chars

SIZES = (3, 4, 5)
SAME = np.uint64(0x5A4D45)


class _Numbers(dict):
    """A number for each word, in the order of first use."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _spread(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def word_grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of each word's features one word after the other, how many each has, a
    hash of each word).  A word's features are itself and its character n-grams."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n) + 2
    code = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    first = ends - sizes
    within = np.arange(len(code)) - np.repeat(first, sizes)
    odd = np.uint64(0x9E3779B97F4A7C15)
    powers = np.cumprod(np.full(int(sizes.max()), odd, np.uint64))
    whole = np.add.reduceat((code + np.uint64(1)) * powers[within], first)
    hashes, owner = [whole], [np.arange(n)]
    number = np.repeat(np.arange(n), sizes)
    left = np.repeat(sizes, sizes) - within
    for size in SIZES:
        at = np.flatnonzero(left >= size)
        h = np.full(len(at), np.uint64(size), np.uint64)
        for i in range(size):
            h = (h ^ code[at + i]) * np.uint64(0x100000001B3) + odd
        hashes.append(h)
        owner.append(number[at])
    flat, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return _spread(flat[order], buckets), np.bincount(owner, minlength=n), whole


def pair_buckets(hashes: np.ndarray, sizes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For documents of ``sizes`` words in a row with these hashes: buckets of the pairs of
    neighbouring words, and the documents they lie in."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
    a, b = hashes[at], hashes[at + 1]
    h = np.where(a == b, SAME, (a * np.uint64(0xC2B2AE3D27D4EB4F)) ^ b)
    return _spread(h, buckets), doc[at]


@dataclass
class QualityModel:
    """A learnt number per bucket (vector times the difference of the outputs), the bias,
    and the score of a text without words.  ``remember``: words kept by a worker before it
    starts anew."""

    weight: np.ndarray
    bias: float
    blank: float
    remember: int = 400_000

    def scorer(self):
        buckets = len(self.weight)
        numbers, value, count, hashes = _Numbers(), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def score(texts: list[str]) -> np.ndarray:
            nonlocal numbers, value, count, hashes
            if len(numbers) > self.remember:
                numbers, value, count, hashes = _Numbers(), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64)
            ids = [np.fromiter(map(numbers.__getitem__, t.split()), np.int64) for t in texts]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            new = list(islice(numbers, len(value), None))
            if new:
                flat, n, own = word_grams(new, buckets)
                value = np.concatenate([value, np.add.reduceat(self.weight[flat], np.cumsum(n) - n)])
                count, hashes = np.concatenate([count, n]), np.concatenate([hashes, own])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(ids)), sizes)
            pairs, pair_doc = pair_buckets(hashes[flat], sizes, buckets)
            total = np.bincount(doc, value[flat], len(ids)) + np.bincount(pair_doc, self.weight[pairs], len(ids))
            n = np.bincount(doc, count[flat], len(ids)) + np.bincount(pair_doc, minlength=len(ids))
            margin = total / np.maximum(n, 1) + self.bias
            return np.where(n > 0, 1 / (1 + np.exp(-np.clip(margin, -40, 40))), self.blank)

        return score


def bags(texts: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's features: distinct buckets, and their shares of the mean."""
    numbers = _Numbers()
    ids = [np.fromiter(map(numbers.__getitem__, t.split()), np.int64) for t in texts]
    flat, n, hashes = word_grams(list(numbers), buckets)
    stop = np.cumsum(n)
    out = []
    for own in ids:
        word, often = np.unique(own, return_counts=True)
        reps = n[word]
        place = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - stop[word], reps)
        pairs, _ = pair_buckets(hashes[own], np.array([len(own)]), buckets)
        bucket, back = np.unique(np.concatenate([flat[place], pairs]), return_inverse=True)
        weight = np.bincount(back, np.concatenate([np.repeat(often, reps), np.ones(len(pairs))]))
        out.append((bucket.astype(np.int32), (weight / max(weight.sum(), 1)).astype(np.float32)))
    return out


def train(texts: list[str], labels, buckets: int = 1 << 18, dim: int = 8, epochs: int = 6, rate: float = 2.0, seed: int = 1) -> QualityModel:
    """Stochastic gradient descent, one document a step, rate falling linearly to nothing.
    A step moves a document's vectors along its shares at unit length, so that long
    documents teach as much as short ones.  A text without words scores the (smoothed) mean
    label of the sample, as does every text if the sample has fewer than two different
    labels."""
    labels = np.asarray(labels, np.int64)
    blank = (float(labels.sum()) + 1) / (len(labels) + 2)
    if len(labels) == 0 or labels.min() == labels.max():
        return QualityModel(np.zeros(buckets), float(np.log(blank / (1 - blank))), blank)
    rng = np.random.default_rng(seed)
    docs = []
    for at in range(0, len(texts), 250):  # a part's arrays are large, its bags are not
        part = bags(texts[at : at + 250], buckets)
        docs += [(b, label) for b, label in zip(part, labels[at : at + 250], strict=True) if len(b[0])]
    emb = rng.uniform(-0.1 / dim, 0.1 / dim, (buckets, dim)).astype(np.float32)
    out = rng.normal(0, 1, (dim, 2)).astype(np.float32)
    bias = np.log(np.array([np.mean(labels == 0), np.mean(labels == 1)])).astype(np.float32)
    total, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            step = rate * (1 - done / total)
            done += 1
            (bucket, share), label = docs[i]
            hidden = share @ emb[bucket]
            p = np.exp((z := hidden @ out + bias) - z.max())
            p /= p.sum()
            p[label] -= 1
            back = out @ p
            out -= np.float32(0.1 * step) * np.outer(hidden, p)
            bias -= np.float32(0.01 * step) * p
            emb[bucket] -= np.float32(step) * np.outer(share / np.linalg.norm(share), back)
    return QualityModel((emb @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]), blank)


def fit_quality_embeddings(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                           max_rows: int = 4_000, max_chars: int = 16_000_000) -> QualityModel:
    """A model of ``label_col`` = 1, learnt from at most ``max_rows`` labelled rows, the
    first in the order of a hash of their ids, and at most ``max_chars`` characters in all:
    rows are taken in that order, each with its whole text, and one that does not fit into
    what is left is passed over.  Both bound the driver's memory.  Rows with a null id or
    label are not used; of contradicting labels the highest holds; an id with several rows
    of text stands for each of them."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
        .groupBy("id").agg(F.max("label").alias("label")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # only ids and sizes are shuffled; texts are read once more, for the chosen rows
    sizes = texts.filter(F.col("text").isNotNull()).select("id", F.length("text").alias("size"))
    first = sizes.join(known.hint("merge"), "id").orderBy(F.xxhash64("id"), "id", "size").select("id", "size").limit(max_rows)
    chosen, left = [], max_chars
    for row in first.collect():
        if row["size"] <= left:
            chosen.append(row)
            left -= row["size"]
    wanted = docs.sparkSession.createDataFrame(sorted(set(chosen)), first.schema)
    # at most max_rows rows on the broadcast side; rows alike in id and size are cut to the sample's number
    rows = texts.withColumn("size", F.length("text")).join(F.broadcast(wanted.join(known.hint("merge"), "id")), ["id", "size"])
    sample = rows.orderBy(F.xxhash64("id"), "id", "size", "text").limit(len(chosen)).select("text", "label").toPandas()
    return train(sample["text"].tolist(), sample["label"].to_numpy())


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (1 from ``threshold`` on).

    Null, empty and blank texts score the sample's mean label.  Whole texts are read,
    however long.  Repeated rows are scored one by one; an empty table gives an empty
    result; only the id and text columns are read, so other names may clash.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def run(batches):
        score = shared.value.scorer()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            parts = [score(texts[a:b]) for a, b in by_chars(texts)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int")
