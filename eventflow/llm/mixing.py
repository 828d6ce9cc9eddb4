"""Mixing sources to target weights by Poisson replication.

A source with weight w of the total and n of the total's size must be repeated
w * total / n times on average.  Each document is repeated k times, k drawn from the
Poisson distribution with that mean by inverting its distribution function at a uniform
number hashed from (seed, id): the draw needs no state, depends on nothing but the row,
and is the same in every run.  Copies are then spread over all partitions by a hash of
(seed, id, copy) and ordered by it: a global shuffle.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import fresh, stored

TERMS = 160  # of the distribution function; means above PART are drawn as sums of parts
PART = 32.0
SALTS = 32


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def distribution(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of the Poisson distribution, ``TERMS`` of them."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))

    def step(acc, k):
        p = acc["p"] * mean / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda acc: acc["all"])


def target_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict | None = None,
                 temperature: float = 0.5, scale: float = 1.0) -> DataFrame:
    """One row per source: source, documents, characters, weight, rate (mean number of
    copies).  Weights are ``weights`` (sources not named get none, and so no copies), or
    the sources' characters to the power ``temperature``.  ``scale`` is the size wanted
    as a share of the input's.  A null source is a source of its own; a source without
    any characters has rate 0, and so has every source if the weights add up to 0."""
    stats = stored(docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(F.length(F.col(text_col)).cast("long")), F.lit(0)).alias("characters")), "mix-sources")
    if weights is None:
        raw = F.pow(F.col("characters").cast("double"), F.lit(float(temperature)))
        raw = F.when(F.col("characters") > 0, raw).otherwise(F.lit(0.0))
    else:
        raw = F.lit(0.0)
        for name, weight in weights.items():
            raw = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(raw)
    stats = stats.withColumn("raw", raw)
    raw_all = stats.agg(F.sum("raw").alias("x")).scalar()
    characters_all = stats.agg(F.sum("characters").alias("x")).scalar()
    weight = F.when(raw_all > 0, F.col("raw") / raw_all).otherwise(F.lit(0.0))
    rate = F.when(F.col("characters") > 0, weight * float(scale) * characters_all / F.col("characters")).otherwise(F.lit(0.0))
    return stats.select("source", "documents", "characters", weight.alias("weight"), rate.alias("rate"))


def replicate(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 42,
              copies_col: str = "n_copies", copy_col: str = "copy", order_col: str = "order_key", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as drawn, spread over all partitions by a hash
    and in its order within them, with the columns ``n_copies`` (of the row), ``copy`` (from 0) and ``order_key``; a
    name that ``docs`` has already gets underscores in front.

    Rows of equal id are drawn alike; a row without an id is drawn by a hash of its text,
    so only rows alike in both are; a null
    source matches the null source of ``rates``; a source without a rate has no copies.
    An empty table gives an empty result.
    """
    key, salt, cdf, parts, copies_col, copy_col, order_col = fresh(
        docs, "rate_source", "rate_salt", "rate_cdf", "rate_parts", copies_col, copy_col, order_col)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    table = rates.select(F.col("source").alias(key), draws.alias(parts), "rate").select(
        key, parts, distribution(F.col("rate") / F.col(parts)).alias(cdf))
    # every source's line is laid out SALTS times, so that a source with a third of all
    # rows meets it in SALTS places
    table = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.concat(F.lit("text:"), F.md5(F.col(text_col).cast("string"))) if text_col in docs.columns else F.lit("")
    name = F.coalesce(F.col(id_col).cast("string"), own, F.lit(""))
    place = F.when(F.col(id_col).isNull(), F.xxhash64(name)).otherwise(F.xxhash64(F.col(id_col)))
    rows = docs.withColumn(salt, F.pmod(place, F.lit(SALTS)).cast("int"))
    joined = rows.join(table, (rows[source_col].eqNullSafe(table[key])) & (rows[salt] == table[salt]), "inner").drop(table[salt])

    def drawn(part):
        u = uniform(F.lit(seed), name, part)
        return F.size(F.filter(F.col(cdf), lambda c: c <= u))

    n = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda acc, part: acc + drawn(part))
    out = joined.withColumn(copies_col, n).filter(F.col(copies_col) > 0)
    out = out.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.col(copies_col) - 1)))
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}:order"), name, F.col(copy_col)))
    out = out.withColumn(order_col, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    return (
        out.select(*[rows[c] for c in docs.columns], copies_col, copy_col, order_col)
        .repartition(F.col(order_col)).sortWithinPartitions(order_col, id_col)
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: dict | None = None, temperature: float = 0.5, scale: float = 1.0, seed: int = 42) -> DataFrame:
    """``docs`` mixed to target weights: its own columns, then n_copies, copy, order_key."""
    rates = stored(target_rates(docs, source_col, text_col, weights, temperature, scale), "mix-rates")
    return replicate(docs, rates, id_col, source_col, seed, text_col=text_col)
