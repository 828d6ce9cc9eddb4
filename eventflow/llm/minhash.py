"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning,
exact verification, connected components.

1. One pass over the texts gives each row its number of distinct word shingles, a
   128-bit hash of its set and a MinHash signature (16 bits a hash).  Rows of equal sets
   are one node; only nodes go on, so copies cost nothing further.
2. Signatures are cut into bands; nodes that agree in a band share a bucket.  Rows and
   hashes per band are chosen so that a pair at the threshold shares no bucket with a
   probability below ``miss``.
3. Every node of a bucket is compared with the bucket's leader: as many pairs as nodes.
   A pair's signatures are compared batch by batch; after n hashes with m agreeing, the
   posterior probability that the similarity reaches the threshold is
   P(Binomial(n + 1, threshold) <= m) under a uniform prior, and the pair is pruned as
   soon as it falls below ``miss``.  Survivors are verified on their full shingle sets.
4. Links give components.  Pairs of a bucket within one component need no comparison;
   the others (neither is the leader, components differ) are compared in blocks: the
   members outside the bucket's largest component against all members, at most about
   ``block`` rows of each a task.  Pairs never leave a task: rows with a surviving pair
   do, come back to the same block with their full sets, and are verified there, each
   pair in the first band that holds it.  The components of all links are the answer.
"""

from __future__ import annotations

from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import by_size, fresh, stored
from eventflow.llm.components import components

BATCH = 32  # hashes compared before each decision


def bands_for(threshold: float, miss: float, most: int = 160) -> tuple[int, int]:
    """(bands, hashes per band): the longest bands within ``most`` hashes at which a
    pair at the threshold shares no band with a probability of ``miss`` at most."""
    for rows in range(16, 0, -1):
        bands = ceil(log(miss) / log(1 - threshold**rows))
        if rows * bands <= most or rows == 1:
            return bands, rows
    raise AssertionError


def least_matches(threshold: float, miss: float, hashes: int) -> dict[int, int]:
    """After n hashes, the fewest agreeing that keep the posterior at ``miss`` or above."""
    out = {}
    for n in [*range(BATCH, hashes, BATCH), hashes]:
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out[n] = m
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word):
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_sets(texts, width: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct word shingles."""
    known = _WordHash()
    out = []
    for text in texts:
        # bytes: lower() changes A-Z only, split() cuts at space and \\t \\n \\v \\f \\r only
        words = text.encode("utf-8").lower().split() if text else []
        if not words:
            out.append(np.zeros(0, np.uint64))
            continue
        if len(known) > 1_000_000:
            known = _WordHash()
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(width, len(words))
        # a text shorter than a shingle is one shingle; its length is part of the hash
        acc = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
        out.append(np.unique(acc))
    return out


def signatures(sets: list[np.ndarray], hashes: int, seed: int = 7) -> np.ndarray:
    """MinHash signatures, the low 16 bits of each minimum; empty sets give zeros."""
    rng = np.random.default_rng(seed)
    mul = rng.integers(1, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, hashes, np.uint64)
    out = np.zeros((len(sets), hashes), np.uint16)
    filled = [i for i, s in enumerate(sets) if len(s)]
    for a, b in by_size([len(sets[i]) for i in filled], 1 << 16):
        rows = filled[a:b]
        flat = np.concatenate([sets[i] for i in rows])
        starts = np.cumsum([0] + [len(sets[i]) for i in rows[:-1]])
        for k in range(hashes):
            value = ((flat * mul[k] + add[k]) >> np.uint64(32)).astype(np.uint32)
            out[rows, k] = np.minimum.reduceat(value, starts).astype(np.uint16)
    return out


def _survivors(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Indices of the rows of two signature arrays that no decision prunes."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, need in least.items():
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(1, dtype=np.int32)
        keep = matches >= need
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def linked(x: np.ndarray, y: np.ndarray, least_pct: int) -> bool:
    """Whether two sorted sets share at least ``least_pct`` in a hundred of their union."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < least_pct * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= least_pct * (len(x) + len(y) - shared)


def _matrix(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), hashes)


class NearDuplicates:
    """The steps above for one table; ``members`` is the result for every row."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 least_pct: int = 80, miss: float = 1e-7, block: int = 1024):
        self.width, self.least_pct, self.block = width, least_pct, block
        self.bands, self.rows = bands_for(least_pct / 100, miss)
        self.hashes = self.bands * self.rows
        self.least = least_matches(least_pct / 100, miss, self.hashes)
        self.texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.texts = self.texts.withColumn("mark", F.xxhash64("text"))
        self.kind = self.texts.schema["id"].dataType.simpleString()
        self.prints = stored(self._prints().withColumn("row", F.monotonically_increasing_id()), "near-prints")
        # one node for each distinct set: its first row
        sets = self.prints.filter("n_shingles > 0").groupBy("set").agg(F.min(F.struct("row", "id", "mark", "sig")).alias("r"))
        self.nodes = stored(sets.select(
            F.col("r.row").alias("node"), "set", F.col("r.id").alias("id"), F.col("r.mark").alias("mark"), F.col("r.sig").alias("sig")), "near-nodes")

    def _prints(self) -> DataFrame:
        width, hashes = self.width, self.hashes

        def run(batches):
            for batch in batches:
                texts = batch.column("text")
                for a, b in by_size([len(t or "") for t in texts.to_pylist()]):
                    sets = shingle_sets(texts.slice(a, b - a).to_pylist(), width)
                    sig = signatures(sets, hashes)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").slice(a, b - a),
                        batch.column("mark").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                    ], ["id", "mark", "n_shingles", "set", "sig"])

        return self.texts.mapInArrow(run, f"id {self.kind}, mark long, n_shingles long, set binary, sig binary")

    def _bucket_rows(self) -> DataFrame:
        size = 2 * self.rows
        keys = [F.xxhash64(F.lit(b), F.substring("sig", 1 + b * size, size)) for b in range(self.bands)]
        return self.nodes.select("node", F.posexplode(F.array(*keys)).alias("band", "bucket"))

    def _similar(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that signatures do not rule out."""
        hashes, least = self.hashes, self.least
        sig_a = self.nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
        sig_b = self.nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    keep = _survivors(_matrix(batch.column("sig_a"), hashes), _matrix(batch.column("sig_b"), hashes), least)
                    yield batch.select(["a", "b"]).take(pa.array(keep))

        joined = pairs.join(sig_a.hint("merge"), "a").join(sig_b.hint("merge"), "b")
        return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")

    def _sets(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles): the full shingle sets of the nodes in ``wanted``.  Texts are
        found by their hash and id, so that rows of one id, or of none, do not all meet."""
        width = self.width
        wanted = wanted.join(self.nodes.select("node", "set", "id", "mark").hint("merge"), "node")

        def run(batches):
            for batch in batches:
                node, own = batch.column("node"), batch.column("set").to_pylist()
                texts = batch.column("text")
                for a, b in by_size([len(t or "") for t in texts.to_pylist()]):
                    sets = shingle_sets(texts.slice(a, b - a).to_pylist(), width)
                    # ids may repeat: only the text that has this node's set counts
                    hit = [i for i, s in enumerate(sets) if xxhash.xxh128_digest(s.tobytes()) == own[a + i]]
                    yield pa.RecordBatch.from_arrays(
                        [node.take(pa.array([a + i for i in hit], pa.int64())), pa.array([sets[i].tobytes() for i in hit], pa.binary())],
                        ["node", "shingles"])

        same = (self.texts["mark"] == wanted["mark"]) & self.texts["id"].eqNullSafe(wanted["id"])
        texts = self.texts.join(wanted.hint("merge"), same).select("node", "set", "text")
        return stored(texts.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"]), "near-sets")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full shingle sets reach the threshold."""
        least_pct = self.least_pct
        pairs = stored(pairs, "near-survivors")
        sets = self._sets(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())

        def run(batches):
            for batch in batches:
                keep = [
                    linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), least_pct)
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        joined = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").select("a", "b", "x", "y")
        return stored(joined.mapInArrow(run, "a long, b long"), "near-links")

    def _rest(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        """Verified links of the pairs of a bucket that are in different components and
        do not include its leader; of each block, as many as connect what is connected.
        ``rows``: band, bucket, node, leader, size."""
        hashes, least, block, least_pct = self.hashes, self.least, self.block, self.least_pct
        bands, per_band = self.bands, self.rows
        rows = rows.filter("size > 2 AND node <> leader").join(labels.hint("merge"), "node", "left")
        rows = stored(rows.select("band", "bucket", "node", F.coalesce("component", "node").alias("label")), "near-rest")
        stats = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
            F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
        stats = stats.filter("all > top.n").select(
            "bucket", F.col("top.label").alias("main"),
            F.ceil(F.col("all") / block).cast("int").alias("blocks"),
            F.ceil((F.col("all") - F.col("top.n")) / block).cast("int").alias("parts"))
        rows = rows.join(stored(stats, "near-mixed").hint("merge"), "bucket")

        def dealt(salt, n):
            return F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(n)).cast("int")

        own = ["band", "bucket", "node", "label"]
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        whole = rows.select(*own, F.lit(False).alias("minor"), dealt("all", "blocks").alias("i"), F.explode(every).alias("j"))
        across = F.sequence(F.lit(0), F.col("blocks") - 1)
        minor = rows.filter("label <> main").select(
            *own, F.lit(True).alias("minor"), F.explode(across).alias("i"), dealt("part", "parts").alias("j"))
        names = ["band", "bucket", "i", "j", "node", "label", "minor", "sig"]
        kinds = "band int, bucket long, i int, j int, node long, label long, minor boolean, sig binary"

        def survivors(table):
            """Pairs of row numbers that signatures leave, each in the first band that
            holds it only, so that it is verified once."""
            minor = np.asarray(table.column("minor"))
            node, label = np.asarray(table.column("node")), np.asarray(table.column("label"))
            sig, band = _matrix(table.column("sig"), hashes), table.column("band")[0].as_py()
            left, right = np.flatnonzero(minor), np.flatnonzero(~minor)
            is_minor = np.isin(node[right], node[left])
            for at in range(0, len(left), 64):  # 64 rows against the block at a time
                some = left[at : at + 64]
                # two minor rows meet from both sides: once is enough where both sides are here
                apart = (label[some][:, None] != label[right][None, :]) & ~((node[some][:, None] > node[right][None, :]) & is_minor[None, :])
                a, b = np.nonzero(apart)
                a, b = some[a], right[b]
                keep = _survivors(sig[a], sig[b], least)
                a, b = a[keep], b[keep]
                first = (sig[a] == sig[b]).reshape(len(a), bands, per_band).all(2).argmax(1) if len(a) else a
                yield a[first == band], b[first == band]

        def grouped(batches, work):
            held, key = [], None
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [np.asarray(batch.column(c)) for c in ("bucket", "i", "j")]
                change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
                edges = [0, *change.tolist(), batch.num_rows]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    own = tuple(int(c[a]) for c in columns)
                    if held and own != key:
                        yield work(pa.Table.from_batches(held).combine_chunks())
                        held = []
                    key = own
                    held.append(batch.slice(a, b - a))
            if held:
                yield work(pa.Table.from_batches(held).combine_chunks())

        def members(batches):
            """The rows of a group that have any pair to verify."""

            def work(table):
                hit = np.zeros(table.num_rows, bool)
                for a, b in survivors(table):
                    hit[a] = hit[b] = True
                return table.select(names).filter(pa.array(hit)).combine_chunks().to_batches()

            for out in grouped(batches, work):
                yield from out

        def verify(batches):
            def work(table):
                node, label = np.asarray(table.column("node")), np.asarray(table.column("label"))
                sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
                parent = {}

                def find(x):
                    while parent.setdefault(x, x) != x:
                        x = parent[x]
                    return x

                links = []
                for left, right in survivors(table):
                    for a, b in zip(left.tolist(), right.tolist(), strict=True):
                        x, y = find(label[a]), find(label[b])
                        if x != y and linked(sets[a], sets[b], least_pct):
                            parent[max(x, y)] = min(x, y)
                            links.append((node[a], node[b]))
                a, b = zip(*links, strict=True) if links else ((), ())
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

            yield from grouped(batches, work)

        def by_group(rows):
            return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

        sig = self.nodes.select("node", "sig")
        keyed = by_group(whole.unionByName(minor).join(sig.hint("merge"), "node")).select(*names)
        left = stored(keyed.mapInArrow(members, kinds), "near-open")
        sets = self._sets(left.select("node").distinct())
        full = by_group(left.join(sets.hint("merge"), "node")).select(*names, "shingles")
        return stored(full.mapInArrow(verify, "a long, b long"), "near-rest-links")

    def links(self) -> DataFrame:
        """Verified links (a, b) between nodes: enough to give every component."""
        rows = self._bucket_rows()
        buckets = rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("size"))
        buckets = stored(buckets.filter("size > 1"), "near-buckets")
        rows = stored(rows.join(buckets.hint("merge"), "bucket"), "near-rows")
        stars = rows.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        first = self._verified(self._similar(stars))
        labels = stored(components(first, "a", "b"), "near-first")
        return first.unionByName(self._rest(rows, labels))

    def members(self) -> DataFrame:
        """One row per row of the table: id, n_shingles, component_id, kept."""
        parts = stored(components(self.links(), "a", "b"), "near-components")
        node_set = self.nodes.select("node", "set")
        part_of_set = node_set.join(parts.hint("merge"), "node", "left").select("set", F.coalesce("component", "node").alias("component"))
        part_of_set = stored(part_of_set, "near-sets-components")
        # only sets that stand for two rows or hang on another set need the joins below
        ids = self.prints.filter("n_shingles > 0").groupBy("set").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
        ids = ids.join(part_of_set.hint("merge"), "set")
        whole = ids.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows")).filter("rows > 1")
        shared = part_of_set.join(stored(whole.drop("rows"), "near-whole").hint("merge"), "component").select("set", "component_id", F.lit(True).alias("shared"))
        out = self.prints.join(stored(shared, "near-shared").hint("merge"), "set", "left")
        component = F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("id"))
        return out.select("id", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least_pct: int = 80,
                    miss: float = 1e-7, block: int = 1024) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a
    text's set holds its distinct ``width``-word shingles (a shorter text is one
    shingle).  Two texts are linked if 100 * shared >= least_pct * joint shingles;
    ``component_id`` is the least id reachable.  Null, empty and blank texts have no
    shingles, no links and are kept.  Rows of equal id are one document: all or none is
    kept.  Null ids do not lend their name to a component unless it has no other id.
    An empty table gives an empty result; only the id and text columns are read.
    """
    return NearDuplicates(docs, id_col, text_col, width, least_pct, miss, block).members()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least_pct: int = 80,
                         miss: float = 1e-7, stable: bool = False) -> DataFrame:
    """The rows of ``docs``, all their columns, with one row of each component: that of
    the least id, of equal ids the first; a null id comes last.  ``stable`` says that
    ``docs`` reads a stored table as it is, whose rows come in the same order each time;
    else it is stored first."""
    row, key = fresh(docs, "row_number", "row_key")
    numbered = (docs if stable else stored(docs, "near-input")).withColumn(row, F.monotonically_increasing_id())
    keyed = numbered.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")).alias(key), F.col(text_col))
    out = near_duplicates(keyed, key, text_col, width, least_pct, miss)
    dropped = out.filter("NOT kept").select(F.col("id.row").alias(row))
    return numbered.join(stored(dropped, "near-dropped").hint("merge"), row, "left_anti").drop(row)
