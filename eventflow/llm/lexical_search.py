"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton.

The terms of all items form one automaton.  Every term is guarded by a boundary mark on
both sides and the scanned text has the same mark in place of everything that is no term
character, so a match is a whole term and its value is the term's number: term
frequencies come straight from the text and no index of the documents is made.  The
automaton's numbers lead to the items that hold the term.

The documents are scanned twice, once for the collection's counts (documents, terms,
documents per term) and once for the scores.  A task keeps the best ``k`` documents of
each item only, so ``k`` rows an item and task are shuffled, never a row per document.

The automaton is broadcast.  Its size is bounded by ``max_postings`` (pairs of an item
and a term); more items are worked off in blocks of that size, each by two scans.
"""

from __future__ import annotations

import uuid
from collections import Counter
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import by_chars, stored, worker_cache

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A term is a maximal run of ASCII letters, digits and anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GUARD = " "
# bytes of UTF-8: A-Z to a-z, other term bytes as they are, all else to the guard
MARKED = bytes(
    ord(chr(b).lower()) if chr(b) in UPPER else b if b >= 0x80 or chr(b) in LOWER or chr(b) in "0123456789" else ord(GUARD)
    for b in range(256))


def marked(text: str | None) -> bytes:
    return (text or "").encode().translate(MARKED)


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term, repeats): the terms of every item; rows of one id are one item."""
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    return (
        items.select(F.col(item_col).alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
        .groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats")))


def item_blocks(postings: DataFrame, max_postings: int) -> list[DataFrame]:
    """Split the items by a hash of their ids into blocks of at most ``max_postings``
    rows; a block of one item may be larger, as large as that item's text makes it."""
    number = F.xxhash64(F.col("item").cast("string"))
    total = postings.count()
    parts = -(-total // max_postings)
    while parts > 1:
        sizes = postings.groupBy(F.pmod(number, F.lit(parts)).alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("item").alias("items"))
        if not sizes.filter((F.col("n") > max_postings) & (F.col("items") > 1)).take(1):
            break
        parts *= 2
    if parts <= 1:
        return [postings]
    return [postings.filter(F.pmod(number, F.lit(parts)) == i) for i in range(parts)]


def automaton(terms: list[str]):
    """The guarded automaton of ``terms``; a match's value is the term's number."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(GUARD + term + GUARD, i)
    found.make_automaton()
    return found


def _kept_automaton(key: str, terms: list[str]):
    """The automaton of a block, made once by each worker, which keeps the latest only."""
    kept = worker_cache("lexical-automaton", dict)
    if kept.get("key") != key:
        kept.clear()
        kept.update(key=key, machine=automaton(terms))
    return kept["machine"]


def scan(machine, text: str | None) -> tuple[Counter, int]:
    """(how often each of the automaton's terms occurs in the text, all its terms)."""
    plain = marked(text)
    line = GUARD + plain.decode() + GUARD
    return Counter(map(itemgetter(1), machine.iter(line))), len(plain.split())


def gain(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A term's part of a document's score, in 64-bit integers."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _best(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = rows.sort_values(["item", "score", "id"], ascending=[True, False, True], na_position="last", kind="stable")
    return rows.groupby("item", sort=False).head(k)


def _search_block(docs: DataFrame, postings: DataFrame, k: int, salts: int) -> DataFrame | None:
    """Best ``k`` documents of the items of one block (None if it has no items)."""
    spark = docs.sparkSession
    rows = postings.collect()  # at most max_postings rows
    if not rows:
        return None
    items = list({r["item"]: None for r in rows})
    terms = sorted({r["term"] for r in rows})
    item_no, term_no = {v: i for i, v in enumerate(items)}, {v: i for i, v in enumerate(terms)}
    # postings by term: items of term t are post_item[first[t]:first[t + 1]]
    flat = np.array(sorted((term_no[r["term"]], item_no[r["item"]], r["repeats"]) for r in rows), np.int64).reshape(-1, 3)
    first = np.searchsorted(flat[:, 0], np.arange(len(terms) + 1))
    post_item, post_repeats = flat[:, 1].copy(), flat[:, 2].copy()
    shared = spark.sparkContext.broadcast((terms, first, post_item, post_repeats))
    key = uuid.uuid4().hex

    def count(batches):
        terms = shared.value[0]
        machine = _kept_automaton(key, terms)
        held, n_docs, n_terms = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                found, n = scan(machine, text.as_py())
                held[np.fromiter(found, np.int64, len(found))] += 1
                n_docs += n > 0
                n_terms += n
        slot = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], slot])), pa.array(np.concatenate([[n_docs, n_terms], held[slot]]))], ["slot", "n"])

    counts = docs.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    known = {r["slot"]: r["n"] for r in counts}  # a number for each term of the block, and two more
    n_docs, n_terms = known.get(-1, 0), known.get(-2, 0)
    df = np.array([known.get(i, 0) for i in range(len(terms))], np.int64)
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    # float64 sums of integers are exact below 2^53
    exact_in_doubles = int(post_repeats.sum()) * int(max(weight.max(initial=0), 1)) * 1_000_000 < 1 << 53
    n_items = len(items)

    def score(batches):
        terms, first, post_item, post_repeats = shared.value
        machine = _kept_automaton(key, terms)
        many = first[1:] - first[:-1]
        best, least = None, np.zeros(n_items, np.int64)  # least: the k-th best score so far
        waiting, n_waiting = [], 0

        def settle():
            nonlocal best, waiting, n_waiting
            best = _best(pd.concat([best, *waiting] if best is not None else waiting, ignore_index=True), k)
            waiting, n_waiting = [], 0
            full = best.groupby("item")["score"].agg(["size", "min"])
            full = full[full["size"] >= k]
            least[full.index.to_numpy(np.int64)] = full["min"].to_numpy(np.int64)

        def take(ids, found):
            """Scores of the documents ``found`` (counts and length of each)."""
            nonlocal n_waiting
            held = np.array([len(f) for f, _ in found], np.int64)
            term = np.concatenate([np.fromiter(f.keys(), np.int64, len(f)) for f, _ in found])
            tf = np.concatenate([np.fromiter(f.values(), np.int64, len(f)) for f, _ in found])
            doc = np.repeat(np.arange(len(found)), held)
            m = 100 - 25 + (25 * np.array([n for _, n in found], np.int64) * n_docs) // max(n_terms, 1)
            part = gain(tf, m[doc], weight[term])
            # every posting of every term of every document
            reps = many[term]
            place = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps - first[term], reps)
            cell = np.repeat(doc * n_items, reps) + post_item[place]
            value = np.repeat(part, reps) * post_repeats[place]
            if exact_in_doubles:
                total = np.bincount(cell, value, len(found) * n_items).astype(np.int64)
            else:
                total = np.zeros(len(found) * n_items, np.int64)
                np.add.at(total, cell, value)
            total = total.reshape(len(found), n_items)
            at, item = np.nonzero((total > 0) & (total >= least))  # ties with the k-th stay
            if len(at):
                waiting.append(pd.DataFrame({"item": item, "score": total[at, item], "id": ids.take(at)}))
                n_waiting += len(at)
                if n_waiting > max(4 * k * n_items, 20_000):
                    settle()

        for batch in batches:
            ids, texts = batch.column("id").to_pandas(integer_object_nulls=True), batch.column("text").to_pylist()
            lengths = [t or "" for t in texts]
            step = max(1, 2_000_000 // max(n_items, 1))
            for a, b in by_chars(lengths):
                for c in range(a, b, step):
                    d = min(b, c + step)
                    take(ids.iloc[c:d].reset_index(drop=True), [scan(machine, t) for t in texts[c:d]])
        if waiting:
            settle()
        if best is not None and len(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(best["item"].to_numpy(np.int64)), pa.array(best["id"].tolist(), id_type),
                 pa.array(best["score"].to_numpy(np.int64))], ["item", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["id"].dataType)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("id", docs.schema["id"].dataType), T.StructField("score", T.LongType())])
    found = docs.mapInArrow(score, schema)
    # a first choice among parts of an item's rows, so that none gathers a row of every task
    order = (F.desc("score"), F.asc_nulls_last("id"))
    part = F.pmod(F.xxhash64("id"), F.lit(salts))
    found = found.withColumn("nth", F.row_number().over(Window.partitionBy("item", part).orderBy(*order))).filter(F.col("nth") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame(
        [(i, v) for i, v in enumerate(items)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", postings.schema["item"].dataType)]))
    # one row an item of the block
    return found.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_col: str = "doc_id", doc_text: str = "text", item_col: str = "item_id",
           item_text: str = "text", max_postings: int = 500_000, salts: int = 64) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id,
    score (above 0; equal scores by ascending id, null ids last).

    Every row of ``docs`` is a document and its whole text is scanned.  Null, empty and
    termless texts are documents without terms: they match nothing and do not count.
    Repeated rows are ranked one by one, rows without an id too.  Items of one id (null
    is an id as well) are one item, with the terms of all its rows; items without terms
    have no rows.  Empty tables give an empty result.  Other columns are not read, so
    their names may clash.
    """
    rows = docs.select(F.col(doc_col).alias("id"), F.col(doc_text).cast("string").alias("text"))
    postings = stored(item_terms(items, item_col, item_text), "item-terms")
    blocks = [b for block in item_blocks(postings, max_postings) if (b := _search_block(rows, block, k, salts)) is not None]
    if not blocks:
        schema = T.StructType([
            T.StructField("item_id", postings.schema["item"].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", rows.schema["id"].dataType), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], schema)
    out = blocks[0]
    for block in blocks[1:]:
        out = out.unionByName(block)
    return out
