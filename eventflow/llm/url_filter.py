"""URL filters: listed rules, and association rules mined from labelled urls.

A url's tokens are its host labels, the words of its path and its query keys.  Spark's
FP-growth finds the token combinations of labelled urls; rules whose consequent is the
label "block" stay if they reach the support, lift and number of blocked rows asked for,
if the confidence is sure to be as high as asked for, not only in the rows seen, and if
no rule on fewer tokens is as confident.  Urls are judged against an inverted index that
lists every rule under its rarest token, so a url looks only at rules it may satisfy.
"""

from __future__ import annotations

from math import ceil

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored

BLOCK = "=block"  # no url token begins with "="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    after = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.coalesce(F.translate(after, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens: ``h:`` host labels and their hyphenated parts, ``p:`` path words
    (numbers as one token), ``q:`` query keys."""
    host, path = url_host(url), F.lower(url_path(url))
    query = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))
    labels = F.split(host, r"[.:@]")
    parts = F.split(host, r"[-_.:@]")
    words = F.transform(F.split(path, r"[^\p{L}\p{N}]+"), lambda w: F.when(w.rlike("^[0-9]+$"), F.lit("0")).otherwise(w))
    keys = F.transform(F.split(query, "&"), lambda kv: F.lower(F.substring_index(kv, "=", 1)))

    def named(prefix, items):
        return F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    return F.array_distinct(F.concat(named("h:", labels), named("h:", parts), named("p:", words), named("q:", keys)))


def surest(hits: Column, rows: Column, z: float) -> Column:
    """The lower end of Wilson's interval, ``z`` standard errors wide, of a rate."""
    rate = hits / rows
    return (rate + z * z / (2 * rows) - z * F.sqrt(rate * (1 - rate) / rows + z * z / (4 * rows * rows))) / (1 + z * z / rows)


def mine_block_rules(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", min_support: float = 0.002,
                     min_confidence: float = 0.6, min_lift: float = 1.5, min_rows: int = 20, z: float = 3.0
                     ) -> list[tuple[frozenset, float]]:
    """(tokens, confidence) of the rules kept; ``label_col`` is boolean, rows with a
    null label are not used.  A rule needs ``min_support`` of the rows and ``min_rows``
    rows that are blocked, and the lower bound of its confidence, ``z`` standard errors
    down, must reach ``min_confidence``: a small table gives no rules by chance.

    Tokens in too few blocked rows are in no rule and are left out; tokens that occur in
    exactly the same rows are mined as one and give one rule each afterwards.  So copies
    of one url, however many tokens it has, give one item, not all subsets of them.
    """
    rows = labelled.filter(F.col(label_col).isNotNull()).select(
        url_tokens(F.col(url_col)).alias("tokens"), F.col(label_col).alias("blocked"))
    rows = stored(rows.filter("blocked OR size(tokens) > 0"), "url-transactions")
    total, blocked = rows.agg(F.count("*"), F.count_if("blocked")).first()
    if not blocked:
        return []
    least = max(ceil(min_support * total), min_rows, 1)
    # row numbers hold for a table read as stored; two hashes of them tell sets of rows apart
    single = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "blocked", F.explode("tokens").alias("token"))
    tokens = single.groupBy("token").agg(
        F.count_if("blocked").alias("hits"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("one"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("two")).filter(F.col("hits") >= least)
    merged = stored(tokens.groupBy("n", "one", "two").agg(F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("tokens")),
                    "url-items")
    items = single.join(merged.select(F.col("item").alias("token")), "token").groupBy("row").agg(
        F.collect_list("token").alias("items"), F.first("blocked").alias("blocked"))
    items = stored(items.select(F.when(F.col("blocked"), F.concat("items", F.array(F.lit(BLOCK)))).otherwise(F.col("items")).alias("items")),
                   "url-item-sets")
    count = items.count()
    if not count:
        return []
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / count).fit(items)
    sets = stored(model.freqItemsets.select(
        F.array_sort(F.array_remove("items", BLOCK)).alias("items"), F.array_contains("items", BLOCK).alias("blocked"), "freq"), "url-frequent")
    rules = sets.filter("blocked AND size(items) > 0").select("items", F.col("freq").alias("hits")).join(
        sets.filter("NOT blocked").select("items", F.col("freq").alias("n")), "items").select(
        "items", "hits", "n", (F.col("hits") / F.col("n")).alias("confidence"))
    rules = stored(rules.filter((F.col("confidence") * total / blocked >= min_lift) & (surest(F.col("hits"), F.col("n"), z) >= min_confidence)),
                   "url-rules")
    # expanded: one rule for each choice of a token from every item
    expanded = prune(rules).withColumn("rule", F.monotonically_increasing_id()).select(
        "rule", "confidence", F.explode("items").alias("item")).join(merged.select("item", "tokens"), "item").groupBy("rule", "confidence").agg(
        F.collect_list("tokens").alias("choices"))
    choices = F.aggregate("choices", F.array(F.array().cast("array<string>")), lambda made, more: F.flatten(
        F.transform(made, lambda m: F.transform(more, lambda t: F.concat(m, F.array(t))))))
    found = expanded.select(F.explode(choices).alias("tokens"), "confidence").collect()
    return sorted(((frozenset(r["tokens"]), float(r["confidence"])) for r in found), key=lambda r: (len(r[0]), sorted(r[0])))


def prune(rules: DataFrame) -> DataFrame:
    """The rules (items, n, confidence) no rule on fewer of their items is as confident as."""
    # most fall to a rule on one item less, found by its key; what is left is compared by
    # one item of the shorter rule, the one in the fewest rules
    def less_one(x, i):
        return F.filter("items", lambda y: y != x)

    near = rules.select("items", F.explode(F.transform("items", less_one)).alias("less"), "confidence").alias("a").join(
        rules.select(F.col("items").alias("less"), F.col("confidence").alias("other")).alias("b"), "less").filter("other >= confidence")
    left = stored(rules.join(near.select("items").distinct(), "items", "left_anti"), "url-rules-left")
    times = left.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("times"))
    rarest = left.select("items", "confidence", F.explode("items").alias("item")).join(times, "item").groupBy(
        F.col("items").alias("short"), F.col("confidence").alias("other")).agg(F.min(F.struct("times", "item"))["item"].alias("item"))
    far = left.select("items", "confidence", F.explode("items").alias("item")).join(rarest, "item").filter(
        (F.size("short") < F.size("items")) & (F.col("other") >= F.col("confidence")) & (F.size(F.array_except("short", "items")) == 0))
    return left.join(far.select("items").distinct(), "items", "left_anti")


def inverted_index(rules) -> dict[str, list]:
    """token -> the rules (tokens, confidence) of which it is the rarest among all rules."""
    times: dict[str, int] = {}
    for tokens, _ in rules:
        for t in tokens:
            times[t] = times.get(t, 0) + 1
    out: dict[str, list] = {}
    for tokens, confidence in rules:
        out.setdefault(min(tokens, key=lambda t: (times[t], t)), []).append((tokens, confidence))
    return out


def listed_rule(host: str, path: str, by_host: dict) -> tuple[str, str] | None:
    """The longest listed rule that fits: its host or a parent domain, and a path prefix."""
    best = None
    labels = host.split(".")
    for i in range(len(labels)):
        for prefix, rule, verdict in by_host.get(".".join(labels[i:]), ()):
            if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                best = (rule, verdict)
    return best


def url_verdicts(pages: DataFrame, listed: list[tuple[str, str]], mined: list[tuple[frozenset, float]],
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, confidence.

    ``listed`` are (rule, verdict) pairs, a rule being host + path such as ``net/es/``;
    the longest that fits decides.  Else the url is blocked if it holds all tokens of a
    mined rule (``confidence`` is the best such rule's, else null) and allowed if not.
    A null url, or one without ``://``, has an empty host and path and no tokens: it is
    allowed.  Repeated rows are judged one by one; an empty table gives an empty result.
    """
    by_host: dict[str, list] = {}
    for rule, verdict in listed:
        host, slash, path = rule.partition("/")
        by_host.setdefault(host, []).append((slash + path, rule, verdict))
    index = inverted_index(mined)
    url = F.col(url_col).cast("string")
    rows = pages.select(
        F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"),
        F.when(url.contains("://"), url_tokens(url)).otherwise(F.array().cast("array<string>")).alias("tokens"))

    def run(batches):
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            rule, verdict, sure = [], [], []
            for host, path, tokens in zip(hosts, paths, batch.column("tokens").to_pylist(), strict=True):
                fit = listed_rule(host, path, by_host)
                best = None
                if index:
                    own = set(tokens or ())
                    best = max((c for t in own for need, c in index.get(t, ()) if need <= own), default=None)
                rule.append(fit[0] if fit else None)
                verdict.append(fit[1] if fit else "block" if best is not None else "allow")
                sure.append(best)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string()), pa.array(sure, pa.float64())],
                ["id", "host", "path", "rule", "verdict", "confidence"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string, confidence double")
