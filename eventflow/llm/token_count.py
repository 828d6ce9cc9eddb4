"""Token counts by rank-synchronous merging of pre-tokens held in ragged arrays.

A batch's distinct pre-tokens are byte symbols in one flat array.  In each round every
unfinished pre-token merges all places of its lowest-ranked pair at once; pre-tokens
without a mergeable pair leave the arrays.  The symbols left are the token count.
Counts of pre-tokens are remembered within a task (bounded), so a frequent word is
merged once.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import by_chars

NO_RANK = np.iinfo(np.int32).max


class PairRanks:
    """(left, right) -> rank and merged symbol, as an open-addressing hash table."""

    def __init__(self, left, right, merged):
        self.bits = max(4, int(np.ceil(np.log2(max(len(left), 1) * 8))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NO_RANK, np.int32)
        self.merged = np.asarray(merged, np.int32)
        keys = (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[slot[waiting]] == -1
            first = waiting[free][np.unique(slot[waiting[free]], return_index=True)[1]]
            self.keys[slot[first]] = keys[first]
            self.rank[slot[first]] = first
            waiting = np.setdiff1d(waiting, first, assume_unique=True)
            slot[waiting] = (slot[waiting] + 1) & (size - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left, right):
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.rank[slot], NO_RANK)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


def merge_counts(symbols: np.ndarray, lengths: np.ndarray, table: PairRanks) -> np.ndarray:
    """Symbols left of each sequence; ``symbols`` holds the sequences one after another."""
    out = lengths.astype(np.int64).copy()
    owner = np.flatnonzero(lengths > 1)
    keep = np.repeat(lengths > 1, lengths)
    flat, lengths = symbols[keep], lengths[owner]
    while len(owner):
        n = len(flat)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        rank = np.full(n, NO_RANK, np.int32)  # of the pair that begins here
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        at = np.flatnonzero(inside)
        rank[at] = table.ranks(flat[at], flat[at + 1])
        lowest = np.minimum.reduceat(rank, starts)
        hit = (rank == np.repeat(lowest, lengths)) & (rank != NO_RANK)
        # of overlapping places (a run of one symbol) every second one merges, from the left
        places = np.flatnonzero(hit)
        new_run = np.ones(len(places), bool)
        new_run[1:] = places[1:] != places[:-1] + 1
        run_start = places[np.maximum.accumulate(np.where(new_run, np.arange(len(places)), 0))] if len(places) else places
        places = places[((places - run_start) & 1) == 0]
        flat[places] = table.merged[rank[places]]
        alive = np.ones(n, bool)
        alive[places + 1] = False
        lengths = np.add.reduceat(alive.astype(np.int64), starts)
        out[owner] = lengths
        going = (lowest != NO_RANK) & (lengths > 1)
        before = ends - starts
        alive &= np.repeat(going, before)
        flat, owner, lengths = flat[alive], owner[going], lengths[going]
    return out


def load_byte_bpe(path: str):
    """(byte -> symbol, pair table, special strings, pattern) of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    vocab, merges = data["model"]["vocab"], data["model"]["merges"]
    # byte-level files name a byte by a printable character: itself where it is
    # printable Latin-1, else the next free character from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    name = {b: chr(b) for b in shown}
    name |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in name)}
    symbol = np.array([vocab[name[b]] for b in range(256)], np.int64)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    table = PairRanks([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], [vocab[a + b] for a, b in pairs])
    special = [t["content"] for t in data.get("added_tokens", [])]
    return symbol, table, special


class _Lookup(dict):
    def __missing__(self, token):
        self[token] = n = len(self)
        return n


class TokenCounter:
    """Counts tokens of texts; ``remember`` bounds the pre-tokens kept in memory."""

    def __init__(self, path: str, pattern: str, remember: int = 400_000):
        import regex

        self.symbol, self.table, self.special = load_byte_bpe(path)
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.remember = remember
        self._forget()

    def _forget(self):
        self.index, self.counts = _Lookup(), np.zeros(0, np.int64)

    def _learn(self):
        new = list(self.index)[len(self.counts):]
        if not new:
            return
        raw = [t.encode("utf-8") for t in new]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.symbol[np.frombuffer(b"".join(raw), np.uint8)]
        self.counts = np.concatenate([self.counts, merge_counts(symbols, lengths, self.table)])

    def count(self, texts) -> np.ndarray:
        if len(self.index) > self.remember:
            self._forget()
        extra = np.zeros(len(texts), np.int64)
        ids, sizes = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if self.cut is not None and self.cut.search(text):
                parts = self.cut.split(text)
                extra[i] = len(parts) - 1
                tokens = [t for part in parts for t in self.find(part)]
            else:
                tokens = self.find(text)
            sizes[i] = len(tokens)
            ids.append(np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens)))
        self._learn()
        sums = np.concatenate([[0], np.cumsum(self.counts[np.concatenate(ids)])]) if ids else np.zeros(1, np.int64)
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes] + extra


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    Special strings inside a text count as one token each, as the tokenizer's library
    does by default.  Null text counts as empty (0 bytes, 0 tokens).  Repeated rows are
    counted one by one; an empty table gives an empty result; only the id and text
    columns are read.  ``tokenizer_path`` must exist on the executors.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = None
        for batch in batches:
            counter = counter or TokenCounter(tokenizer_path, pattern)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            parts = [counter.count(texts[a:b]) for a, b in by_chars(texts)]
            n = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            size = np.fromiter((len(t.encode("utf-8")) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(size), pa.array(n), pa.array(n > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
