"""Spelling variants: words one edit apart, grouped under the frequent form.

Letters are hashed to a few symbols, so a word becomes a reduced word.  If two words are
one inserted, deleted or replaced code point apart, their reduced words are equal or one
edit apart.  The full one-edit neighbourhood of every reduced word (itself, every
replacement, deletion and insertion over the few symbols) is joined with the reduced
vocabulary, and pairs are verified on the original strings inside the join.

Neighbourhoods are made in numpy as rolling hashes: prefix and suffix sums give the hash
of each neighbour without writing it out.  Equal reduced words have equal hashes, so none
is missed; unequal ones that collide are verified like all others.  A bitmap of the
reduced vocabulary's hashes, of a fixed size (``filter_bits``), is broadcast and drops
neighbours that are no reduced word before the shuffle; it never drops one that is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"A-Za-zÀ-ÿ"
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
BITMAP_BITS = 32_768  # bits of one of Spark's bitmaps


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, slip_every: int | None = None) -> DataFrame:
    """(word) for every maximal run of letters with at least ``least`` code points, A-Z
    lower-cased.  With ``slip_every`` a run whose hash with its row's id is divisible by
    it lacks the code point at that hash modulo its length, and is left out if too short
    then.  Null and empty texts have no runs; a null id counts as the empty string."""
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("word"))
    if not slip_every:
        return runs.select("word")
    h = F.crc32(F.concat_ws(":", "id", "word").cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    slipped = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % slip_every == 0, slipped).otherwise(F.col("word")).alias("word"))
    return words.filter(F.length("word") >= least)


def word_counts(words: DataFrame, least: int = 2) -> DataFrame:
    """(word, n): the words that occur at least ``least`` times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a rolling hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def symbols_of(words: list[str], symbols: int) -> np.ndarray:
    """The reduced words of ``words``, all of one length, as a matrix of symbols from 1."""
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashed = ((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(symbols)
    return (hashed + np.uint64(1)).reshape(len(words), -1 if words[0] else 0)


def neighbourhoods(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of all strings at most one edit from each reduced word (a row each); the
    first column is the word itself."""
    m, size = reduced.shape
    base, inverse = np.uint64(BASE), np.uint64(INVERSE)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]), dtype=np.uint64)
    parts = reduced * power[:size]
    before = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(parts, 1, dtype=np.uint64)], 1)
    whole = before[:, -1:]
    after = whole - before  # from each place on
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    out = [whole]
    if size:
        replaced = whole[:, :, None] + (every[None, None, :] - reduced[:, :, None]) * power[None, :size, None]
        out.append(replaced.reshape(m, -1))
        out.append(before[:, :-1] + after[:, 1:] * inverse)
    inserted = (before + after * base)[:, :, None] + every[None, None, :] * power[None, :, None]
    out.append(inserted.reshape(m, -1))
    return mixed(np.concatenate(out, 1))


def _by_length(words: list[str], limit: int = 20_000):
    """(places, words) of runs of words with the same length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        step = max(1, limit * 8 // (int(size) + 1))
        for a in range(0, len(at), step):
            places = at[a : a + step]
            yield places, [words[i] for i in places]


def reduced_hashes(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """``vocabulary`` (word, n) with the hash of the word's reduced form as ``key``."""

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            key = np.zeros(len(words), np.uint64)
            for at, same in _by_length(words):
                reduced = symbols_of(same, symbols)
                power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(reduced.shape[1], np.uint64(BASE), np.uint64)]), dtype=np.uint64)
                key[at] = mixed((reduced * power[:-1]).sum(1, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(key.view(np.int64))], ["word", "n", "key"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, key long")


def key_bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """One bit for each key's hash modulo ``bits``: as many bytes whatever the number of
    keys, and exact in the direction that counts (a key's bit is always set)."""
    place = F.pmod(F.col("key"), F.lit(bits))
    rows = (
        keys.select(place.alias("place")).groupBy(F.floor(F.col("place") / BITMAP_BITS).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place") % BITMAP_BITS).alias("map")).collect())  # bits / 8 bytes at most
    out = np.zeros(-(-bits // 8 // 4096) * 4096, np.uint8)
    for row in rows:
        part = np.frombuffer(row["map"], np.uint8)
        out[int(row["part"]) * 4096 : int(row["part"]) * 4096 + len(part)] = part
    return out


def near_pairs(vocabulary: DataFrame, symbols: int = 8, filter_bits: int = 1 << 26) -> DataFrame:
    """(word, near, near_n) for every ordered pair of words of ``vocabulary`` (word, n;
    words unique) that differ by exactly one inserted, deleted or replaced code point."""
    if filter_bits & (filter_bits - 1):
        raise ValueError("filter_bits must be a power of two")
    spark = vocabulary.sparkSession
    keyed = stored(reduced_hashes(vocabulary, symbols), "reduced-vocabulary")
    bitmap = spark.sparkContext.broadcast(key_bitmap(keyed, filter_bits))  # filter_bits / 8 bytes

    def spread(batches):
        known = bitmap.value
        for batch in batches:
            column = batch.column("word")
            words = column.to_pylist()
            for at, same in _by_length(words):
                keys = neighbourhoods(symbols_of(same, symbols), symbols)
                place = (keys & np.uint64(filter_bits - 1)).astype(np.int64)
                there = (known[place >> 3] >> (place & 7).astype(np.uint8)) & 1
                row, col = np.nonzero(there)
                if not len(row):
                    continue
                # a neighbour that comes about in several ways counts once
                pairs = np.unique(np.stack([row.astype(np.uint64), keys[row, col]], 1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [column.take(pa.array(at[pairs[:, 0].astype(np.int64)])), pa.array(pairs[:, 1].copy().view(np.int64))], ["word", "key"])

    left = keyed.select("word").mapInArrow(spread, "word string, key long").alias("a")
    right = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge").alias("b")
    verified = F.levenshtein(F.col("a.word"), F.col("b.near"), 1) == 1
    return left.join(right, (F.col("a.key") == F.col("b.key")) & verified).select("word", "near", "near_n")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word of the chain.  A form occurs more
    often than its word, so chains end; each round doubles the steps taken, and as counts
    grow by a factor with each link the rounds are few (five for a factor of 10)."""
    reach = stored(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        ahead = reach.select(F.col("word").alias("root"), F.col("root").alias("further")).hint("merge")
        reach = stored(
            reach.select("word", "root").join(ahead, "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not reach.filter("moved").take(1):
            return reach.select("word", "root")


def variant_groups(vocabulary: DataFrame, factor: int = 10, symbols: int = 8, filter_bits: int = 1 << 26) -> DataFrame:
    """For every word of ``vocabulary`` (word, n): n, the number of near words n_near, its
    form (the near word of largest n, the least of equal ones, if that n is at least
    ``factor`` times the word's), form_n, and the root its forms lead to (itself if none).

    ``factor`` must be above 1.  Words are compared as they are; a null word is left out, a
    repeated word's counts are added; an empty vocabulary gives an empty result; other
    columns are not read.
    """
    if factor <= 1:
        raise ValueError("factor must be above 1, else chains of forms need not end")
    words = stored(vocabulary.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n")), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    near = near_pairs(words, symbols, filter_bits).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.order") >= F.lit(factor) * F.col("n")
    judged = stored(
        words.join(near.hint("merge"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.order")).alias("form_n")), "spelling-forms")
    root = roots(judged.filter(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(root.hint("merge"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
