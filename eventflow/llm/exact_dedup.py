"""Exact deduplication by 128-bit content hash with a byte comparison inside groups.

Texts are equal when their UTF-8 bytes are; nothing is normalised and null counts as
the empty text.  Steps:

1. one pass over the texts stores (id, row, 128-bit hash, SHA-256), about 100 bytes a row;
2. hash groups of two or more rows get their size and the row that stays (map-side
   partial aggregation, so a group with a third of all rows is a few rows per task);
3. grouping by (hash, whole text) compares the bytes: copies collapse map-side, and a
   hash that comes out with two texts is a collision.  Collided hashes (normally none)
   leave the hash path and are grouped by their whole text instead;
4. every row takes its group's answer by a join on the hash.  Both sides are stored
   tables, so the optimiser splits a hot hash over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import fresh, stored, text_or_empty


def md5_128(text: Column) -> Column:
    return F.md5(text)


def _groups(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    pick = F.max if keep == "max" else F.min
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            # a null id loses against any other; equal ids are told apart by the row number
            pick(F.when(F.col("id").isNotNull(), F.struct("id", "row"))).alias("best"),
            F.min("row").alias("first_row"),
        )
        .filter("group_size > 1")
        .select(
            *keys,
            "group_size",
            F.col("best.id").alias("keep_id"),
            F.coalesce("best.row", "first_row").alias("keep_row"),
        )
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    hash_fn=md5_128,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    ``keep`` is ``min`` or ``max``: which id of equal texts stays.  Exactly one row of
    each group is kept: among rows with that same id, the first (or last) in scan order;
    null ids stay only if the whole group has no id (``keep_id`` is then null).  Null
    text counts as empty; empty texts equal each other.  An empty table gives an empty
    result; other columns of ``docs`` are not read, whatever their names.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    prints = stored(
        source.select("id", "row", hash_fn(F.col("text")).alias("h"), F.sha2("text", 256).alias("text_sha256")),
        "exact-prints",
    )
    groups = stored(_groups(prints, ["h"], keep), "exact-groups")

    texts = docs.select(text_or_empty(text_col).alias("text")).withColumn("h", hash_fn(F.col("text")))
    collided = stored(
        texts.groupBy("h", "text").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1").select("h"),
        "exact-collided",
    )

    if collided.isEmpty():
        return _answers(prints, groups, ["h"])
    same = stored(
        source.withColumn("h", hash_fn(F.col("text"))).join(collided, "h", "left_semi")
        .select("id", "row", "h", "text", F.sha2("text", 256).alias("text_sha256")),
        "exact-collided-rows",
    )
    rest = prints.join(collided, "h", "left_anti")
    return _answers(rest, groups, ["h"]).unionByName(
        _answers(same, stored(_groups(same, ["h", "text"], keep), "exact-collided-groups"), ["h", "text"])
    )


def _answers(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    alone = F.col("group_size").isNull()
    return rows.join(groups, keys, "left").select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                          stable: bool = False) -> DataFrame:
    """The rows of ``docs``, all their columns, without exact copies (see above).  Rows
    are told apart by their place in the table, so ids may repeat.  ``stable`` says that
    ``docs`` reads a stored table as it is, whose rows come in the same order each time;
    else it is stored first."""
    row, key = fresh(docs, "row_number", "row_key")
    numbered = (docs if stable else stored(docs, "exact-input")).withColumn(row, F.monotonically_increasing_id())
    last = F.col(id_col).isNull() if keep == "min" else F.col(id_col).isNotNull()
    keyed = numbered.select(F.struct(last, F.col(id_col), F.col(row).alias("row")).alias(key), F.col(text_col))
    dropped = exact_duplicates(keyed, key, text_col, keep).filter("NOT kept").select(F.col("id.row").alias(row))
    return numbered.join(stored(dropped, "exact-dropped").hint("merge"), row, "left_anti").drop(row)
