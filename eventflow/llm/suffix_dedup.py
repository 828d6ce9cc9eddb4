"""Removal of repeated byte strings: column-wise construction of a collection's
Burrows-Wheeler transform with common prefixes.

Every byte covered by a string of ``length`` bytes that starts anywhere else in the
table too is removed.  Steps:

1. Anchors.  Each window of ``length`` bytes names one place inside it, the 32-byte gram
   of the least hash; neighbouring windows mostly name the same place.  The place
   depends on the window's bytes alone, so equal windows name equal grams at equal
   offsets.  A segment is an anchor with all windows that name it (about 250 bytes).
   Only segments whose gram occurs at two anchors or more can hold a repeated window.
2. Byte-identical segments of a gram become one row with a count (map-side first).
3. The distinct segments of a gram are aligned at it and go through the construction:
   columns are visited from right to left, each inserting one symbol of every segment;
   a stable sort by the new symbol of the order before gives the order of all suffixes
   that start in this column (their transform), and the common prefix of neighbours is
   one more than the least common prefix between their former places.  Each column's
   order and prefixes go to a sequential file, which is read once to mark the windows
   whose neighbour shares ``length`` bytes.  As equal windows have equal offsets, the
   suffixes of one column are the only ones to compare, and the transform is kept by
   column; its cost is linear in the segments' bytes.
4. A gram with more than ``most`` distinct segments (a frequent passage in many
   contexts) is split: into runs of 16 window starts, grouped by the bytes that all
   windows of the run share, and if need be into single windows, so no group of
   unbounded size reaches a task, and copies collapse again after each split.
5. Marked windows go back to the documents, and the bytes they cover are cut out.

Matches never cross documents; strings are judged on the input.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import by_size, stored

GRAM = 32
RUNS = (16, 1)  # window starts a run holds, split by split
STEP = 1 << 22  # windows handled at a time; places in a step must fit 24 bits


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all 32-byte grams, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    step, factor = 1, 0x9E3779B97F4A7C15
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % (1 << 64)
        step *= 2
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, 1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(data: bytes, length: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, first window, number of windows) of each anchor."""
    if len(data) < length:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    width = length - GRAM + 1
    out = []
    for start in range(0, len(data) - length + 1, step):
        part = np.frombuffer(data, np.uint8)[start : start + step + length - 1]
        h = gram_hashes(part)
        low = np.uint64((1 << 24) - 1)
        # of equal hashes in a window the leftmost is the least
        least = window_minima((h & ~low) | np.arange(len(h), dtype=np.uint64), width)
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        n = np.diff(first, append=len(place))
        out.append((h[place[first]], place[first] + start, first + start, n))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_windows(rows: list[bytes], column: np.ndarray, starts: np.ndarray, weight: np.ndarray, length: int) -> list[np.ndarray]:
    """For segments aligned by ``column`` (the column of their first byte), each with
    windows at its first ``starts`` bytes and standing for ``weight`` equal segments:
    the windows, by number, that another segment or an equal one has too."""
    m = len(rows)
    size = np.fromiter(map(len, rows), np.int64, m)
    width = int((column + size).max())
    symbols = np.zeros((width, m), np.uint8)  # by column
    flat = np.frombuffer(b"".join(rows), np.uint8)
    owner = np.repeat(np.arange(m), size)
    symbols[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + column[owner], owner] = flat
    end = column + size
    enter = np.argsort(-end, kind="stable")
    enter_end = -end[enter]
    order, prefix, entered = np.zeros(0, np.int32), np.zeros(0, np.int16), 0
    with tempfile.TemporaryFile() as file:  # the task's own, gone with it
        columns = []
        for c in range(width - 1, int(column.min()) - 1, -1):
            # segments that end with this column: their empty suffix comes first
            upto = int(np.searchsorted(enter_end, -c, side="left"))
            if upto > entered:
                fresh = enter[entered:upto].astype(np.int32)
                order = np.concatenate([fresh, order])
                prefix = np.concatenate([np.zeros(len(fresh) + 1, np.int16), prefix[1:]])[: len(order)]
                entered = upto
            # segments that began to the right are complete
            live = column[order] <= c
            if not live.all():
                at = np.flatnonzero(live)
                if not len(at):
                    order, prefix = order[:0], prefix[:0]
                    continue
                # common prefix across those that leave: the least of what lies between
                order, prefix = order[at], np.minimum.reduceat(prefix[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
                prefix[0] = 0
            if not len(order):
                continue
            symbol = symbols[c, order]
            to = np.argsort(symbol, kind="stable")
            sorted_symbol = symbol[to]
            same = np.zeros(len(to), bool)
            same[1:] = sorted_symbol[1:] == sorted_symbol[:-1]
            new = np.zeros(len(to), np.int16)
            k = np.flatnonzero(same)
            if len(k):
                bounds = np.stack([to[k - 1] + 1, to[k] + 1], 1).ravel()
                padded = np.append(prefix, np.int16(0))
                new[k] = np.minimum.reduceat(padded, bounds)[::2] + 1
            order, prefix = order[to], new
            if int(prefix.max(initial=0)) >= length:
                hit = prefix >= length
                hit[:-1] |= hit[1:]
                at = np.flatnonzero(hit)
                file.write(order[at].tobytes())
                columns.append((c, len(at)))
        file.seek(0)
        segment, window = [np.flatnonzero(weight > 1).repeat(starts[weight > 1])], []
        window.append(np.concatenate([np.arange(n) for n in starts[weight > 1]]) if (weight > 1).any() else np.zeros(0, np.int64))
        for c, n in columns:
            own = np.frombuffer(file.read(4 * n), np.int32)
            segment.append(own)
            window.append(c - column[own])
    segment, window = np.concatenate(segment).astype(np.int64), np.concatenate(window).astype(np.int64)
    code = np.unique(segment << 20 | window)
    segment, window = code >> 20, code & ((1 << 20) - 1)
    cut = np.searchsorted(segment, np.arange(m + 1))
    return [window[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def runs_of(numbers: np.ndarray) -> np.ndarray:
    """[first, last, first, last, ...] of the runs of consecutive numbers."""
    if not len(numbers):
        return numbers
    new = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 2) > 1)
    return np.stack([numbers[new], numbers[np.append(new[1:], len(numbers)) - 1]], 1).ravel()


def _long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class RepeatedBytes:
    """The steps above for one table; ``documents`` is the result."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, most: int = 512,
                 batch: int = 8192, stable: bool = False):
        if length < 2 * GRAM:
            raise ValueError(f"length must be at least {2 * GRAM}")
        self.length, self.most, self.batch = length, most, batch
        rows = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("data"))
        if not stable:  # row numbers must be the same each time the table is read
            rows = stored(rows, "repeat-input")
        self.rows = rows.withColumn("row", F.monotonically_increasing_id())
        self.kind = rows.schema["id"].dataType.simpleString()

    def _grams(self) -> DataFrame:
        length = self.length

        def run(batches):
            for batch in batches:
                data = batch.column("data").to_pylist()
                for a, b in by_size(list(map(len, data))):
                    h = [anchors(d, length)[0] for d in data[a:b]]
                    yield pa.RecordBatch.from_arrays([pa.array(_long(np.concatenate(h)))], ["g"])

        return self.rows.select("data").mapInArrow(run, "g long")

    def _segments(self) -> DataFrame:
        """g: gram, h: hash of the bytes, row, at: first window * 256 + windows, back:
        bytes from the first window to the gram."""
        length = self.length

        def run(batches):
            for batch in batches:
                data, row = batch.column("data").to_pylist(), np.asarray(batch.column("row"))
                for a, b in by_size(list(map(len, data))):
                    parts = []
                    for i in range(a, b):
                        g, place, first, n = anchors(data[i], length)
                        view = memoryview(data[i])
                        h = np.fromiter((xxhash.xxh3_64_intdigest(view[s : s + k + length - 1]) for s, k in zip(first.tolist(), n.tolist(), strict=True)), np.uint64, len(g))
                        parts.append((_long(g), _long(h), np.full(len(g), row[i]), first * 256 + n, (place - first).astype(np.int16)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["g", "h", "row", "at", "back"])

        return self.rows.select("data", "row").mapInArrow(run, "g long, h long, row long, at long, back short")

    def _packed(self) -> DataFrame:
        """The documents' bytes, compressed, to be shuffled by row."""

        def run(batches):
            for batch in batches:
                packed = [pa.compress(d, codec="zstd", asbytes=True) for d in batch.column("data").to_pylist()]
                size = pa.array([len(d) for d in batch.column("data").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), size, pa.array(packed, pa.binary())], ["row", "id", "n_bytes", "packed"])

        return self.rows.mapInArrow(run, f"row long, id {self.kind}, n_bytes long, packed binary")

    def _with_bytes(self, classes: DataFrame) -> DataFrame:
        """``classes`` (g, h, w, row, at, back) with their bytes, cut from one of the
        documents that have them, and the column of their first byte."""
        length, last = self.length, self.length - GRAM

        def run(batches):
            for batch in batches:
                place, out = [c.as_py() for c in batch.column("want")], []
                packed, size = batch.column("packed").to_pylist(), batch.column("n_bytes").to_pylist()
                for want, p, n in zip(place, packed, size, strict=True):
                    data = pa.decompress(p, n, codec="zstd", asbytes=True)
                    for w in want:
                        first, starts = w["at"] >> 8, w["at"] & 255
                        piece = data[first : first + starts + length - 1]
                        if xxhash.xxh3_64_intdigest(piece) != w["h"] % (1 << 64):
                            raise ValueError("the table changed between two reads; pass stable=False")
                        out.append((w["g"], w["h"], w["w"], last - w["back"], starts, piece))
                columns = list(zip(*out, strict=True)) if out else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["g", "h", "w", "col", "n", "bytes"])

        # the wanted segments of a document: at most its own bytes over the least distance of anchors
        want = classes.groupBy("row").agg(F.collect_list(F.struct("g", "h", "w", "at", "back")).alias("want"))
        joined = self._packed().join(want.hint("merge"), "row")
        return joined.select("want", "packed", "n_bytes").mapInArrow(run, "g long, h long, w long, col int, n int, bytes binary")

    def _construct(self, rows: DataFrame) -> DataFrame:
        """Marks of (g, h) rows whose groups are small: windows as runs."""
        length, most_rows = self.length, self.batch

        def marks(table):
            table = table.combine_chunks()
            column, n = (np.asarray(table.column(c)).astype(np.int64) for c in ("col", "n"))
            found = repeated_windows(table.column("bytes").to_pylist(), column, n, np.asarray(table.column("w")), length)
            hit = [i for i, f in enumerate(found) if len(f)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(table.column(c))[hit]) for c in ("g", "h")]
                + [pa.array([runs_of(found[i]).astype(np.int32) for i in hit], pa.list_(pa.int32()))], ["g", "h", "runs"])

        def run(batches):
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                if size < most_rows:
                    continue
                table = pa.Table.from_batches(held)
                g = np.asarray(table.column("g"))
                cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
                if cut:
                    yield marks(table.slice(0, cut))
                    held = table.slice(cut).combine_chunks().to_batches()
                    size -= cut
            if size:
                yield marks(pa.Table.from_batches(held))

        dealt = rows.repartition("g").sortWithinPartitions("g")
        return dealt.select("g", "h", "w", "col", "n", "bytes").mapInArrow(run, "g long, h long, runs array<int>")

    def _split(self, rows: DataFrame, run_starts: int) -> DataFrame:
        """Each row cut into runs of window starts; grouped by what their windows share."""
        length = self.length

        def run(batches):
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    data, col, end = row["bytes"], row["col"], row["col"] + row["n"]
                    for first in range(col - col % run_starts, end, run_starts):
                        a, b = max(first, col), min(first + run_starts, end)
                        shared = data[first + run_starts - 1 - col : first + length - col] if run_starts > 1 else data[a - col : a - col + length]
                        piece = data[a - col : b - col + length - 1]
                        g = xxhash.xxh3_64_intdigest(shared, seed=first + 1)
                        h = xxhash.xxh3_64_intdigest(piece, seed=a + 1)
                        out.append((row["g"], row["h"], a - col, g - (1 << 63), h - (1 << 63), row["w"], a, b - a, piece))
                names = ["pg", "ph", "shift", "g", "h", "w", "col", "n", "bytes"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                columns = list(zip(*out, strict=True)) if out else [[]] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        return rows.select("g", "h", "w", "col", "n", "bytes").mapInArrow(
            run, "pg long, ph long, shift int, g long, h long, w long, col int, n int, bytes binary")

    def _marks(self, rows: DataFrame, splits: tuple[int, ...]) -> DataFrame:
        """(g, h, runs) of ``rows`` (g, h, w, col, n, bytes), one row for each (g, h)."""
        if not splits:
            return self._construct(rows)
        sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
        large = stored(sizes.filter(F.col("rows") > self.most).select("g"), "repeat-large")
        if large.isEmpty():
            return self._construct(rows)
        hot = rows.join(large.hint("merge"), "g")
        parts = stored(self._split(hot, splits[0]), "repeat-parts")
        # equal parts collapse in two steps, so that their bytes travel once
        firsts = parts.groupBy("g", "h").agg(
            F.sum("w").alias("w"), F.first("col").alias("col"), F.first("n").alias("n"), F.first("bytes").alias("bytes"))
        marks = self._marks(stored(firsts, "repeat-firsts"), splits[1:])
        back = parts.select("pg", "ph", "shift", "g", "h").join(stored(marks, "repeat-part-marks").hint("merge"), ["g", "h"])
        shifted = F.transform("runs", lambda x: x + F.col("shift"))
        whole = back.groupBy(F.col("pg").alias("g"), F.col("ph").alias("h")).agg(F.flatten(F.collect_list(shifted)).alias("runs"))
        return self._construct(rows.join(large.hint("merge"), "g", "left_anti")).unionByName(whole)

    def windows(self) -> DataFrame:
        """(row, first, last): runs of repeated windows of each document."""
        grams = self._grams().groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g")
        found = stored(self._segments().join(stored(grams, "repeat-grams").hint("merge"), "g"), "repeat-segments")
        classes = found.groupBy("g", "h").agg(
            F.count(F.lit(1)).alias("w"), F.min(F.struct("row", "at", "back")).alias("one"))
        classes = classes.select("g", "h", "w", "one.row", "one.at", "one.back")
        rows = stored(self._with_bytes(classes), "repeat-classes")
        marks = stored(self._marks(rows, RUNS), "repeat-marks")
        hits = found.join(marks.hint("merge"), ["g", "h"])
        first = F.shiftright("at", 8)
        return hits.select("row", F.transform("runs", lambda x: x + first).alias("runs"))

    def documents(self) -> DataFrame:
        length = self.length

        def run(batches):
            for batch in batches:
                spans, kept = [], []
                packed, size = batch.column("packed").to_pylist(), batch.column("n_bytes").to_pylist()
                for p, n, runs in zip(packed, size, batch.column("all_runs").to_pylist(), strict=True):
                    data = pa.decompress(p, n, codec="zstd", asbytes=True)
                    if not runs:
                        spans.append([])
                        kept.append(data)
                        continue
                    flat = np.concatenate(runs).astype(np.int64)
                    edge = np.zeros(n + 1, np.int32)
                    np.add.at(edge, flat[0::2], 1)
                    np.add.at(edge, flat[1::2] + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    change = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                    spans.append(change)
                    kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("n_bytes"), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
                    ["id", "n_bytes", "spans", "kept"])

        runs = self.windows().groupBy("row").agg(F.collect_list("runs").alias("all_runs"))
        joined = self._packed().join(runs.hint("merge"), "row", "left")
        return joined.select("id", "n_bytes", "packed", "all_runs").mapInArrow(
            run, f"id {self.kind}, n_bytes long, spans array<long>, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, stable: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, spans (first byte, end, first byte, end ... of
    the maximal removed runs), kept (the remaining bytes one after another).

    Null text counts as empty; texts shorter than ``length`` bytes keep all.  Equal rows
    repeat each other, so texts of ``length`` bytes or more that occur twice lose all;
    rows of equal or null id are judged one by one.  An empty table gives an empty
    result; only the id and text columns are read.  ``stable`` says that ``docs`` reads
    a stored table as it is, whose rows come in the same order each time; else the two
    columns are stored first.
    """
    return RepeatedBytes(docs, id_col, text_col, length, stable=stable).documents()
