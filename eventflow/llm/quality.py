"""Quality rules: gradient-boosted trees over document statistics.

The statistics of a document are counted over its whole text in one pass.  A small
boosted ensemble is fitted on a bounded sample of labelled rows (histogram splits,
logistic loss, Newton leaf values, monotonic constraints on the features that may only
lower quality) and flattened into numpy node arrays; scoring walks all rows of a batch
through each tree level at once.

Null text has no words.  Repeated rows are judged one by one; an empty table gives an
empty result; only the id and text columns are read.  Without any usable labels the
trees are empty and only the base rules decide.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import WORD_PATTERN

SYMBOLS = "#*$%&|<>"
FEATURES = (
    "log_words", "mean_word_chars", "distinct_words", "words_per_line", "upper_share", "digit_share",
    "stops_per_word", "symbols_per_word", "bangs_per_word", "pipes_per_word", "dup_line_share", "repeat_share",
)
# more of these never raises the predicted quality
FALLING = ("symbols_per_word", "bangs_per_word", "pipes_per_word", "dup_line_share", "repeat_share")


class _Ids(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur at two or more places of the text."""
    if len(ids) < 4:
        return 0
    width = int(ids.max()) + 1
    pairs = ids[:-1] * width + ids[1:]
    if width >= 1 << 21:  # keep the code of a window inside 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    code = pairs[:-1] * width + ids[2:]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(code), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(code)] |= again
    return int(covered.sum())


def statistics(texts) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features) of a list of texts; counts are n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words."""
    find, has_word = re.compile(WORD_PATTERN).findall, re.compile(WORD_PATTERN).search
    symbols = [ord(c) for c in SYMBOLS]
    counts = np.zeros((len(texts), 5), np.int64)
    features = np.zeros((len(texts), len(FEATURES)))
    known = _Ids()
    for i, text in enumerate(texts):
        words = find(text or "")
        if not words:
            continue
        if len(known) > 1_000_000:
            known = _Ids()
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        lines = text.split("\n")
        dup = filled = 0
        seen = set()
        for line in lines:
            if has_word(line):
                filled += 1
                if line in seen:
                    dup += 1
                seen.add(line)
        raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        n, chars = len(words), len("".join(words))
        n_symbols, repeat = int(raw[symbols].sum()), repeated_words(ids)
        counts[i] = n, chars, n_symbols, dup, repeat
        features[i] = (
            np.log1p(n), chars / n, len(set(words)) / n, n / filled,
            raw[65:91].sum() / chars, raw[48:58].sum() / chars, raw[[44, 46]].sum() / n,
            n_symbols / n, raw[33] / n, raw[124] / n, dup / filled, repeat / n,
        )
    return counts, features


@dataclass
class Trees:
    """Node arrays of all trees: internal nodes have feature >= 0; leaves point to
    themselves.  ``roots`` are the trees' first nodes."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    base: float = 0.0
    depth: int = 0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                feature = self.feature[node]
                down = np.where(x[rows, np.maximum(feature, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(feature < 0, node, down)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2,
              bins: int = 48, ridge: float = 1.0, least: float = 2.0, falling=FALLING) -> Trees:
    """Newton boosting of the logistic loss; y is 0 or 1."""
    if len(y) == 0 or y.min() == y.max():
        return Trees(base=0.0 if len(y) == 0 else (4.0 if y[0] else -4.0))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    sign = np.array([-1 if name in falling else 0 for name in FEATURES[: x.shape[1]]])
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(g, h, low, high):
        return float(np.clip(-g / (h + ridge), low, high))

    def grow(rows, level, low, high, g, h):
        me = len(nodes)
        nodes.append([-1, 0.0, me, me, rate * leaf(g[rows].sum(), h[rows].sum(), low, high)])
        if level == depth or len(rows) < 2 * least:
            return me
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
            wl = np.clip(-gl / (hl + ridge), low, high)
            wr = np.clip(-(gs - gl) / (hs - hl + ridge), low, high)
            gain = -(gl * wl + 0.5 * (hl + ridge) * wl**2) - ((gs - gl) * wr + 0.5 * (hs - hl + ridge) * wr**2)
            gain += gs * leaf(gs, hs, low, high) + 0.5 * (hs + ridge) * leaf(gs, hs, low, high) ** 2
            ok = (nl >= least) & (len(rows) - nl >= least) & (sign[f] * (wr - wl) >= 0)
            gain = np.where(ok, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (f, k, wl[k], wr[k]))
        if best[1] is None:
            return me
        f, k, wl, wr = best[1]
        go = binned[rows, f] <= k
        # below a constrained split no leaf of one side may pass the middle of both
        middle = (wl + wr) / 2
        left_bounds, right_bounds = ((middle, high), (low, middle)) if sign[f] else ((low, high), (low, high))
        left = grow(rows[go], level + 1, *left_bounds, g, h)
        right = grow(rows[~go], level + 1, *right_bounds, g, h)
        nodes[me][:4] = [f, float(cuts[f][k]), left, right]
        return me

    every = np.arange(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        start = len(nodes)
        roots.append(grow(every, 0, -4.0, 4.0, p - y, p * (1 - p)))
        tree = _flat(nodes[start:], start, depth)
        margin = margin + tree.margin(x)
    out = _flat(nodes, 0, depth)
    out.roots, out.base = np.array(roots, np.int32), base
    return out


def _flat(nodes, start, depth) -> Trees:
    a = list(zip(*nodes, strict=True))
    return Trees(np.array(a[0], np.int32), np.array(a[1]), np.array(a[2], np.int32) - start,
                 np.array(a[3], np.int32) - start, np.array(a[4]), np.zeros(1, np.int32), 0.0, depth)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_train_rows: int = 20_000) -> Trees:
    """Trees for ``label_col`` = 1, fitted on at most ``max_train_rows`` labelled rows,
    the first in the order of a hash of their ids.  Rows with a null id or label are
    not used; of contradicting labels the lowest holds."""
    sample = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
        .groupBy("id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(max_train_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = "place long, label int, " + ", ".join(f"{f} double" for f in FEATURES)

    def features(batches):
        for batch in batches:
            x = statistics(batch.column("text").to_pylist())[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("label"), *map(pa.array, x.T)], ["place", "label", *FEATURES]
            )

    # the sample's size is bounded by max_train_rows, so it may be broadcast
    rows = (
        texts.join(F.broadcast(sample), "id").select(F.xxhash64("id").alias("place"), "label", "text")
        .mapInArrow(features, schema).orderBy("place", *FEATURES).limit(max_train_rows).toPandas()
    )
    return fit_trees(rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float))


def judged(texts, trees: Trees, least_words: int, most_repeat_pct: int, threshold: float):
    """(counts, base_failed, quality, kept) arrays of a list of texts."""
    counts, x = statistics(texts)
    failed = (counts[:, 0] < least_words) | (100 * counts[:, 4] > most_repeat_pct * counts[:, 0])
    quality = trees.probability(x)
    return counts, failed, quality, ~failed & (quality >= threshold)


def quality_verdicts(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text",
                     least_words: int = 50, most_repeat_pct: int = 50, threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, the counts, base_failed, kept and the predicted quality."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            counts, failed, quality, kept = judged(
                batch.column("text").to_pylist(), trees, least_words, most_repeat_pct, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, counts.T), pa.array(failed), pa.array(kept), pa.array(quality)],
                ["id", *names, "base_failed", "kept", "quality"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, {', '.join(f'{n} long' for n in names)}, base_failed boolean, kept boolean, quality double")


def keep_quality(docs: DataFrame, trees: Trees, text_col: str = "text", least_words: int = 50,
                 most_repeat_pct: int = 50, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, that pass the base rules and the trees."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(
                judged(batch.column(at).to_pylist(), trees, least_words, most_repeat_pct, threshold)[3]))

    return docs.mapInArrow(run, docs.schema)
