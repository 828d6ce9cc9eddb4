"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 6, with word borders) and itself, each
hashed to one of ``buckets`` embeddings.  A bag of words is the mean of its subword
vectors and goes through a linear softmax with two classes; embeddings and output layer
are trained together, in numpy, on a bounded sample.  Misspellings share most n-grams
with the word they stand for and so its vectors.

A document is scored by its most toxic stretch: every run of ``span`` consecutive words
is a bag, over the whole text, and the highest counts; a single insult in a long text is
not averaged away.  Training does the same: in each round every document is represented
by the run that the current model scores highest (clean ones by a random run too).
As averaging is linear, a bag's score is the mean of one number per subword, so scoring
needs the embeddings' projections only.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import by_chars, by_size

GRAMS = (3, 4, 5, 6)


class _Lookup(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat bucket numbers of the words' subwords and how many each word has."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(len(code))
    left = np.repeat(ends, sizes) - place  # characters from here to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    value = np.zeros(len(code), np.uint64)
    hashes, owners = [], []
    for n in range(1, max(GRAMS) + 1):
        # the hash of the n characters from each place, built up character by character
        nxt = np.zeros(len(code), np.uint64)
        if n - 1 < len(code):
            nxt[: len(code) - n + 1] = code[n - 1 :]
        value = (value ^ (nxt + np.uint64(0x9E37))) * np.uint64(0x100000001B3) + np.uint64(n)
        if n in GRAMS:
            ok = left >= n
            hashes.append(value[ok])
            owners.append(owner[ok])
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64)) if len(words) else np.zeros(0, np.uint64)
    if len(words):
        hashes.append(np.add.reduceat(code * powers[place - np.repeat(starts, sizes)], starts))
        owners.append(np.arange(len(words)))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    flat = flat[order]
    flat ^= flat >> np.uint64(31)
    flat = (flat * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)
    return (flat % np.uint64(buckets)).astype(np.int64), np.bincount(owner, minlength=len(words))


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def top_runs(value: np.ndarray, count: np.ndarray, sizes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of ``sizes`` words in a row, given each word's summed score and its
    number of subwords: (highest mean of a run, its first word, its last word + 1).
    Documents without words have mean 0."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    v = np.concatenate([[0.0], np.cumsum(value)])
    c = np.concatenate([[0], np.cumsum(count)])
    # runs begin at every word that has a whole run before its document's end, else at the first
    runs = np.maximum(sizes - span + 1, np.minimum(sizes, 1))
    total = int(runs.sum())
    doc = np.repeat(np.arange(len(sizes)), runs)
    first = np.arange(total) - np.repeat(np.cumsum(runs) - runs, runs) + starts[doc]
    last = np.minimum(first + span, ends[doc])
    mean = (v[last] - v[first]) / np.maximum(c[last] - c[first], 1)
    best, begin, end = np.zeros(len(sizes)), starts.copy(), starts.copy()
    filled = np.flatnonzero(runs)
    if len(filled):
        at = np.cumsum(runs) - runs
        best[filled] = np.maximum.reduceat(mean, at[filled])
        hit = np.flatnonzero(mean == best[doc])
        pick = hit[np.searchsorted(doc[hit], filled)]
        begin[filled], end[filled] = first[pick], last[pick]
    return best, begin, end


@dataclass
class Toxicity:
    """What scoring needs: a number per bucket, the output bias, and the calibration."""

    weight: np.ndarray
    bias: float
    span: int
    slope: float = 1.0
    shift: float = 0.0
    remember: int = 400_000

    def scorer(self):
        index, value, count = _Lookup(), np.zeros(0), np.zeros(0, np.int64)

        def score(texts) -> np.ndarray:
            nonlocal index, value, count
            if len(index) > self.remember:
                index, value, count = _Lookup(), np.zeros(0), np.zeros(0, np.int64)
            ids, sizes = [], np.zeros(len(texts), np.int64)
            for i, text in enumerate(texts):
                words = words_of(text)
                sizes[i] = len(words)
                ids.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
            new = list(islice(index, len(value), None))
            if new:
                flat, n = subwords(new, len(self.weight))
                sums = np.concatenate([[0.0], np.cumsum(self.weight[flat])])
                at = np.cumsum(n)
                value = np.concatenate([value, sums[at] - sums[at - n]])
                count = np.concatenate([count, n])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            best, _, _ = top_runs(value[flat], count[flat], sizes, self.span)
            margin = self.slope * (best + self.bias) + self.shift
            return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))

        return score


def gradients(params, sub: np.ndarray, bag: np.ndarray, n_bags: int, target: np.ndarray, weight: np.ndarray, decay: float):
    """Of the weighted softmax loss plus ``decay`` / 2 times the squares of embeddings and
    output layer, by (embeddings, output layer, bias).  ``sub`` are subwords' buckets and
    ``bag`` their bags in ascending order; no bag is empty."""
    emb, out, bias = params
    size = np.maximum(np.bincount(bag, minlength=n_bags), 1)
    hidden = np.add.reduceat(emb[sub], np.searchsorted(bag, np.arange(n_bags))) / size[:, None]
    logits = hidden @ out + bias
    logits -= logits.max(1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(1, keepdims=True)
    p[np.arange(n_bags), target] -= 1
    g = p * weight[:, None]
    back = (g @ out.T) / size[:, None]
    by_bucket = np.stack([np.bincount(sub, back[bag, d], len(emb)) for d in range(emb.shape[1])], 1)
    return [by_bucket + decay * emb, hidden.T @ g + decay * out, g.sum(0)]


def train(texts: list, labels: np.ndarray, buckets: int = 1 << 17, dim: int = 8, span: int = 8, rounds: int = 80,
          rate: float = 0.5, decay: float = 1e-6, seed: int = 1) -> Toxicity:
    """Joint training of embeddings and softmax by momentum steps whose length is set per
    matrix, not per number, so that rare subwords move as little as they matter.  Without both labels the score
    is the labels' mean."""
    labels = np.asarray(labels, np.int64)
    if len(labels) == 0 or labels.min() == labels.max():
        mean = 0.5 if len(labels) == 0 else float(labels[0])
        return Toxicity(np.zeros(buckets), 0.0, span, 0.0, float(np.clip(np.log((mean + 1e-3) / (1 - mean + 1e-3)), -6, 6)))
    rng = np.random.default_rng(seed)
    index = _Lookup()
    own = [np.fromiter(map(index.__getitem__, words_of(t)), np.int32) for t in texts]
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ids = np.concatenate(own)
    del own
    names, parts = list(index), []
    for at in range(0, len(names), 20_000):  # the arrays of a part are large, its result is not
        part, n = subwords(names[at : at + 20_000], buckets)
        parts.append((part.astype(np.int32), n))
    flat, count = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
    del names, parts
    word_end = np.cumsum(count)
    word_start = word_end - count
    ends = np.cumsum(sizes)
    starts = ends - sizes
    emb = rng.normal(0, 0.05, (buckets, dim)).astype(np.float32)
    out = rng.normal(0, 0.05, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    params = [emb, out, bias]
    moment, square = [np.zeros_like(p) for p in params], [0.0] * 3
    filled = np.flatnonzero(sizes)
    truth = labels[filled]
    balance = np.where(truth == 1, 0.5 / (truth == 1).sum(), 0.5 / (truth == 0).sum())

    def word_scores():
        weight = (emb @ (out[:, 1] - out[:, 0])).astype(np.float64)
        value = np.zeros(len(count))
        for a, b in by_size(count.tolist(), 2_000_000):
            sums = np.concatenate([[0.0], np.cumsum(weight[flat[word_start[a] : word_end[b - 1]]])])
            value[a:b] = sums[word_end[a:b] - word_start[a]] - sums[word_start[a:b] - word_start[a]]
        return value

    # before the model knows anything, a run is as suspicious as its words' document
    # frequencies differ between the labels (squared z values)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    seen = np.unique(doc * len(index) + ids)
    del doc
    seen_word, seen_toxic = seen % max(len(index), 1), labels[seen // max(len(index), 1)] == 1
    toxic_docs, clean_docs = (truth == 1).sum(), (truth == 0).sum()
    in_toxic = np.bincount(seen_word[seen_toxic], minlength=len(index))
    in_clean = np.bincount(seen_word[~seen_toxic], minlength=len(index))
    share = (in_toxic + in_clean + 1) / (toxic_docs + clean_docs + 2)
    z = (in_toxic / toxic_docs - in_clean / clean_docs) / np.sqrt(share * (1 - share) * (1 / toxic_docs + 1 / clean_docs))
    suspicion = np.where(z > 2, z * z, 0.0)

    for t in range(rounds):
        begin = starts[filled] + rng.integers(0, np.maximum(sizes[filled] - span + 1, 1))
        end = np.minimum(begin + span, ends[filled])
        value = suspicion if t < rounds // 4 else word_scores()
        _, b, e = top_runs(value[ids], np.ones(len(ids), np.int64) if t < rounds // 4 else count[ids], sizes, span)
        clean = truth == 0  # clean documents: their top run and a random one
        begin, end = np.concatenate([b[filled], begin[clean]]), np.concatenate([e[filled], end[clean]])
        weight, target = np.concatenate([balance, balance[clean]]), np.concatenate([truth, truth[clean]])
        # the subwords of each bag
        n = end - begin
        in_bag = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        word = ids[in_bag]
        k = count[word]
        sub = flat[np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(word_start[word], k)]
        bag = np.repeat(np.repeat(np.arange(len(n)), n), k)
        grads = gradients(params, sub, bag, len(n), target, weight, decay)
        for i, (w, gr) in enumerate(zip(params, grads, strict=True)):
            moment[i] = 0.9 * moment[i] + 0.1 * gr
            square[i] = 0.95 * square[i] + 0.05 * float(np.square(gr).max())
            step = (moment[i] / (1 - 0.9 ** (t + 1))) / (np.sqrt(square[i] / (1 - 0.95 ** (t + 1))) + 1e-12)
            w -= (rate * step).astype(np.float32)
    value = word_scores()
    best, _, _ = top_runs(value[ids], count[ids], sizes, span)
    model = Toxicity((emb @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]), span)
    # calibrate the highest bag's margin on the sample (logistic regression on one number)
    x = best[filled] + model.bias
    scale = max(float(x.std()), 1e-9)
    slope, shift = 1.0 / scale, -float(x.mean()) / scale
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        r, h = q - truth, np.maximum(q * (1 - q), 1e-6) * balance
        a = np.array([[np.sum(h * x * x) + 1e-4, np.sum(h * x)], [np.sum(h * x), np.sum(h) + 1e-4]])
        d = np.linalg.solve(a, [np.sum(balance * r * x) + 1e-4 * slope, np.sum(balance * r) + 1e-4 * shift])
        slope, shift = slope - d[0], shift - d[1]
    model.slope, model.shift = float(max(slope, 1e-6)), float(shift)
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 max_per_label: int = 2_000, max_chars: int = 14_000_000) -> Toxicity:
    """A model of ``label_col`` = 1, trained on at most ``max_per_label`` rows of each
    label, the first in the order of a hash of their ids among those with a text, and at
    most half of ``max_chars`` characters a label: rows are taken in that order, each with
    its whole text, and one that does not fit into what is left is passed over.  Both
    bound the driver's memory; scoring has no such bounds.  Rows with a null id or label
    are not used; of contradicting labels the highest holds; an id with several rows of
    text stands for each of them."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
        .groupBy("id").agg(F.max("label").alias("label")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # only ids and sizes are shuffled; texts are read once more, for the chosen rows
    sizes = texts.filter(F.col("text").isNotNull()).select("id", F.length("text").alias("size"))
    sizes = sizes.join(known.hint("merge"), "id").withColumn("place", F.xxhash64("id"))
    order = ("place", "id", "size")
    first = sizes.filter("label = 1").orderBy(*order).limit(max_per_label).unionByName(
        sizes.filter("label = 0").orderBy(*order).limit(max_per_label))
    chosen, left = [], {0: max_chars // 2, 1: max_chars // 2}
    for row in sorted(first.collect(), key=lambda r: (r["place"], r["id"], r["size"])):
        if row["size"] <= left[row["label"]]:
            chosen.append((row["id"], row["size"], row["label"]))
            left[row["label"]] -= row["size"]
    wanted = docs.sparkSession.createDataFrame(sorted(set(chosen)), first.select("id", "size", "label").schema)
    # at most 2 * max_per_label rows on the broadcast side; rows alike in id and size are cut to the sample's number
    rows = texts.withColumn("size", F.length("text")).join(F.broadcast(wanted), ["id", "size"])
    sample = rows.orderBy(F.xxhash64("id"), "id", "size", "text").limit(len(chosen)).select("text", "label").toPandas()
    return train(sample["text"].tolist(), sample["label"].to_numpy())


def toxicity_scores(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (1 from ``threshold`` on).

    Null, empty and blank texts have the score of an empty bag.  Repeated rows are
    scored one by one; an empty table gives an empty result; only the id and text
    columns are read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        score = model.scorer()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            parts = [score(texts[a:b]) for a, b in by_chars(texts)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int")
