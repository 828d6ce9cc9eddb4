"""Order-preserving packing of documents into token windows by dynamic programming.

The documents of a partition form one token stream in row order.  Window cuts may be
placed at every document end, at every sentence end, and, where a stretch of more than
``4 * forced_step`` tokens has neither, at every ``forced_step`` tokens.  ``cost[i]``, the least cost of a stream cut at candidate ``i``,
is the minimum over the candidates ``j`` at most one window back of

    cost[j] + padding(pos[i] - pos[j]) + penalty[i] + sequence_cost

Padding is ``window - length``, so the minimum of ``cost[j] + pos[j]`` over a sliding
window answers it in constant time with a monotone queue; lengths that are a power of
two need no padding and are looked up by position.  The stream is solved block by
block; the last window of a block stays open and is solved again with the next block,
so memory does not grow with the partition.  Nothing is shuffled: partitions are packed
side by side and each leaves at most one short window.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import by_size, worker_cache

SENTENCE_END = ".!?\n"
TRAILING = ".,!?;:)#$%&*|\"\n"  # may follow a word without being joined to it


def window_cuts(pos: np.ndarray, penalty: np.ndarray, window: int, sequence_cost: float) -> tuple[list[int], float]:
    """Indices of the chosen cuts, from 0 to the last candidate, and their cost.
    ``pos`` rises strictly from 0; neighbours are at most ``window`` apart."""
    n = len(pos)
    # candidates with another candidate exactly a power of two before them, as flat lists
    index = np.full(int(pos[-1]) + 1, -1, np.int32)
    index[pos] = np.arange(n)
    later, earlier = [], []
    for size in (1 << k for k in range(window.bit_length()) if 1 << k <= window):
        i = np.flatnonzero(pos >= size)
        j = index[pos[i] - size]
        later.append(i[j >= 0])
        earlier.append(j[j >= 0])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    exact = earlier[np.argsort(later, kind="stable")].tolist()
    first = np.concatenate([[0], np.cumsum(np.bincount(later, minlength=n))]).tolist()
    at, extra = pos.tolist(), (penalty + sequence_cost).tolist()
    cost, came = [0.0] * n, [0] * n
    queue, head, key = [0], 0, [0.0] * n
    for i in range(1, n):
        p = at[i]
        while p - at[queue[head]] > window:
            head += 1
        j = queue[head]
        best = key[j] + window - p
        for k in exact[first[i] : first[i + 1]]:
            if cost[k] <= best:
                best, j = cost[k], k
        cost[i] = best = best + extra[i]
        came[i] = j
        key[i] = v = best + p
        while len(queue) > head and key[queue[-1]] >= v:
            queue.pop()
        queue.append(i)
        if head > 4096:
            del queue[:head]
            head = 0
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1], cost[-1]


class ChunkTokenizer:
    """Token ids of texts, chunk by chunk: spaces and line feeds never lie inside a
    token of the tokenizer, so a text's ids are its chunks' ids one after another.

    A batch's distinct chunks are found in Arrow.  A chunk is a word and its trailing
    punctuation where that gives the same ids, so that "Word", "word," and "word." share
    one encoding.  Words are encoded by the library, many to a call, and remembered for
    later batches (at most about ``remember`` of them).
    """

    def __init__(self, path: str, end_id: int, remember: int = 800_000):
        from tokenizers import Tokenizer

        self.library, self.end_id, self.remember = Tokenizer.from_file(path), end_id, remember
        vocabulary = self.library.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self):
        # of words and of what may trail them: their ids one after another, where each
        # begins, how many it has; word 0 is empty
        self.words = {"": 0}
        self.ids, self.first, self.size = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encode_words(self, words: list[str]):
        """Flat ids and the number of ids of each word."""
        out = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(out), np.uint32), np.fromiter(map(len, out), np.int64, len(out))

    def _encode_joined(self, words: list[str], together: int = 64):
        """The same for single words: encoded many to a call and cut where a word ends."""
        groups = [words[i : i + together] for i in range(0, len(words), together)]
        parts = self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        ids, counts = [], []
        for group, part in zip(groups, parts, strict=True):
            own = np.array(part.ids, np.uint32)
            ends = np.flatnonzero(self.closes[own]) + 1
            if len(ends) == len(group):
                ids.append(own)
                counts.append(np.diff(ends, prepend=0))
            else:  # a word of several parts: one by one
                own, count = self._encode_words(group)
                ids.append(own)
                counts.append(count)
        return np.concatenate(ids), np.concatenate(counts)

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words; those not known yet are encoded first."""
        known = self.words
        unseen = [w for w in words if w not in known]
        if unseen:
            single = pc.utf8_is_alpha(pa.array(unseen, pa.string())).to_numpy(zero_copy_only=False)
            for chosen, encode in ((single, self._encode_joined), (~single, self._encode_words)):
                some = [unseen[i] for i in np.flatnonzero(chosen).tolist()]
                if some:
                    ids, count = encode(some)
                    base = len(self.size)
                    self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
                    self.size, self.ids = np.concatenate([self.size, count]), np.concatenate([self.ids, ids])
                    known.update(zip(some, range(base, base + len(some)), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _chunk_words(self, chunk: pa.Array) -> np.ndarray:
        """Two numbers for each chunk: its word's and its trailing punctuation's."""
        body = pc.utf8_rtrim(chunk, characters=TRAILING)
        # lower-casing A-Z first changes nothing unless it makes a composable pair (the
        # tokenizer composes before it lower-cases); such chunks stay as they are
        lowered = pc.ascii_lower(body)
        plain = pc.utf8_is_alpha(body).to_numpy(zero_copy_only=False).copy()
        other = np.flatnonzero(plain & ~pc.string_is_ascii(body).to_numpy(zero_copy_only=False))
        for form in (body, lowered):
            some = form.take(pa.array(other))
            plain[other] &= pc.equal(pc.utf8_normalize(some, "NFC"), some).to_numpy(zero_copy_only=False)
        head = pc.if_else(pa.array(plain), lowered, chunk).dictionary_encode()
        cut = np.flatnonzero(plain & pc.not_equal(body, chunk).to_numpy(zero_copy_only=False))
        whole, bare = chunk.take(pa.array(cut)).to_pylist(), body.take(pa.array(cut)).to_pylist()
        tails = [c[len(b):] for c, b in zip(whole, bare, strict=True)]
        out = np.zeros((len(chunk), 2), np.int64)
        out[:, 0] = self._numbers(head.dictionary.to_pylist())[head.indices.to_numpy()]
        distinct = {t: i for i, t in enumerate(dict.fromkeys(tails))}
        if tails:
            out[cut, 1] = self._numbers(list(distinct))[[distinct[t] for t in tails]]
        return out

    def batch(self, texts):
        """A batch's chunks: (ids, first, size, ends) of its distinct chunks, chunk 0
        being the end of a document; the chunk numbers of all texts; where texts end."""
        if len(self.words) > self.remember:
            self._forget()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", "\n "), " ")
        coded = split.flatten().dictionary_encode()
        parts = self._chunk_words(coded.dictionary).ravel()
        size = self.size[parts]
        at = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[parts] - (at - size), size) + np.arange(at[-1] if len(at) else 0)]
        size = np.concatenate([[1], size[0::2] + size[1::2]])
        ids = np.concatenate([np.array([self.end_id], np.uint32), ids])
        ends = np.zeros(len(size), bool)
        for mark in SENTENCE_END:
            ends[1:] |= pc.ends_with(coded.dictionary, mark).to_numpy(zero_copy_only=False)
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        chunk = np.insert(coded.indices.to_numpy() + 1, last, 0)
        return (ids, np.cumsum(size) - size, size, ends), chunk, last + np.arange(len(last))

    def encode(self, texts):
        return gather(*self.batch(texts))


def gather(table, chunk: np.ndarray, doc_last: np.ndarray):
    """(ids, tokens of each text, positions of sentence ends) with the end id after each text."""
    ids, first, size, ends = table
    n = size[chunk]
    at = np.cumsum(n)
    out = ids[np.repeat(first[chunk] - (at - n), n) + np.arange(at[-1])]
    return out, np.diff(at[doc_last], prepend=0), at[ends[chunk]]


def candidates(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int, sentence_penalty: float,
               forced_penalty: float, forced_step: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut may be, from 0 to ``total``, and the penalty of each: every
    document end, every sentence end, and forced places in stretches of more than
    ``4 * forced_step`` tokens without either."""
    def rising(*parts):
        every = np.sort(np.concatenate(parts))
        return every[np.flatnonzero(np.diff(every, prepend=-1) > 0)]

    natural = rising(doc_ends[doc_ends <= total], sentence_ends[sentence_ends <= total], [0, total])
    wide = np.flatnonzero(np.diff(natural) > min(window, 4 * forced_step))
    forced = [np.arange(natural[i] + forced_step, natural[i + 1], forced_step) for i in wide]
    pos = rising(natural, *forced).astype(np.int64)
    cost = np.full(total + 1, float(forced_penalty))
    cost[sentence_ends[sentence_ends <= total]] = sentence_penalty
    cost[doc_ends] = cost[0] = 0.0
    return pos, cost[pos]


class StreamPacker:
    """Packs a stream of documents; yields pieces as columns."""

    def __init__(self, tokenizer, window, block_tokens, sentence_penalty, forced_penalty, forced_step, sequence_cost):
        self.tokenizer, self.window, self.block = tokenizer, window, block_tokens
        self.penalties, self.sequence_cost = (sentence_penalty, forced_penalty, forced_step), sequence_cost
        self.sequence = 0
        self.ids, self.sentences = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        self.held = 0
        # of each document in the stream: key, its place in the stream (may be negative
        # when its beginning is already packed), its number of tokens
        self.docs, self.place, self.tokens = [], [], []

    def add(self, keys, texts):
        table, chunk, last = self.tokenizer.batch(texts)
        begin = 0
        for a, b in by_size(np.diff(last, prepend=-1).tolist(), 600_000):
            end = int(last[b - 1]) + 1
            ids, tokens, sentences = gather(table, chunk[begin:end], last[a:b] - begin)
            begin = end
            self.docs += keys[a:b]
            self.place += (self.held + np.cumsum(tokens) - tokens).tolist()
            self.tokens += tokens.tolist()
            self.sentences.append(sentences + self.held)
            self.ids.append(ids)
            self.held += len(ids)
            if self.held >= self.block:
                yield self.solve(False)

    def solve(self, final: bool):
        if not self.held:
            return None
        ids, sentences = np.concatenate(self.ids), np.concatenate(self.sentences)
        place, tokens = np.array(self.place), np.array(self.tokens)
        pos, penalty = candidates(len(ids), place + tokens, sentences, self.window, *self.penalties)
        cuts = pos[window_cuts(pos, penalty, self.window, self.sequence_cost)[0]]
        if not final:
            cuts = cuts[:-1]  # the last window stays open
        done = int(cuts[-1])
        begins = np.union1d(cuts, place[(place > 0) & (place < done)])
        begins, ends = begins[:-1], begins[1:]
        doc = np.searchsorted(place, begins, side="right") - 1
        seq = np.searchsorted(cuts, begins, side="right") - 1
        raw = ids[:done].astype("<u4").tobytes()
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        out = ([self.docs[d] for d in doc.tolist()], begins - place[doc], ends - begins, np.array(crc, np.int64),
               tokens[doc], self.sequence + seq, begins - cuts[seq], ids, begins, ends)
        self.sequence += len(cuts) - 1
        first = int(np.searchsorted(place + tokens, done, side="right"))
        self.docs, self.place, self.tokens = self.docs[first:], (place[first:] - done).tolist(), self.tokens[first:]
        self.ids, self.sentences = [ids[done:].copy()], [sentences[sentences > done] - done]
        self.held = len(self.ids[0])
        return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 2048, end_id: int = 1, with_ids: bool = False, block_tokens: int = 1 << 19,
                   sentence_penalty: float = 4.0, forced_penalty: float = 16.0, forced_step: int = 32,
                   sequence_cost: float = 8.0) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``with_ids``, the token ids.

    Each document is its ids and then ``end_id``; every id lies in exactly one piece.
    Null and empty texts are the end id alone.  Repeated rows are packed one by one, in
    the order of the table's partitions; an empty table gives an empty result; only the
    id and text columns are read.  ``sequence_id`` is the partition's number times 2**32
    plus the window's number there.  ``tokenizer_path`` must exist on the executors.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = rows.schema["id"].dataType

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark.sql.pandas.types import to_arrow_type

        base = TaskContext.get().partitionId() << 32
        id_type = to_arrow_type(kind)
        packer = None

        def piece_rows(out):
            keys, start, length, crc, total, seq, offset, ids, begins, ends = out
            columns = [pa.array(keys, id_type), *map(pa.array, (start, length, crc, total, seq + base, offset))]
            if with_ids:
                columns.append(pa.array([ids[a:b].astype(np.int32) for a, b in zip(begins, ends, strict=True)], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

        for batch in batches:
            if packer is None:
                tokenizer = worker_cache(("chunks", tokenizer_path, end_id), lambda: ChunkTokenizer(tokenizer_path, end_id))
                packer = StreamPacker(tokenizer, window, block_tokens, sentence_penalty, forced_penalty, forced_step, sequence_cost)
            keys, texts = batch.column("id").to_pylist(), batch.column("text")
            for a, b in by_size(pc.binary_length(texts).fill_null(0).to_pylist(), 32_000_000):
                for out in packer.add(keys[a:b], texts.slice(a, b - a)):
                    yield piece_rows(out)
        if packer is not None and (out := packer.solve(True)) is not None:
            yield piece_rows(out)

    longs = ", ".join(f"{n} long" for n in names[1:])
    return rows.mapInArrow(run, f"id {kind.simpleString()}, {longs}" + ", ids array<int>" * with_ids)
