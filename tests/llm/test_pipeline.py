import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eventflow.llm.common import read_table, stored
from eventflow.llm.quality import fit_quality, quality_verdicts
from tests.conftest import SF_SMALL
from tests.llm.test_minhash import brute as near_brute


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = read_table(spark, SF_SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        out[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_keeps_what_the_rules_keep(spark, steps):
    before, after = steps["quality"]
    trees = fit_quality(before, read_table(spark, SF_SMALL, "labels"))
    want = {r["id"] for r in quality_verdicts(before, trees).filter("kept").collect()}
    assert set(rows(after)) == want
    clean = read_table(spark, SF_SMALL, "labels").filter("quality = 1").join(before, "doc_id")
    clean = [r["doc_id"] for r in clean.collect() if len((r["text"] or "").split()) >= 50]
    assert len(set(clean) & want) > 0.95 * len(clean)


def test_exact_dedup_keeps_the_least_id_of_each_text(steps):
    before, after = steps["exact_dedup"]
    least = {}
    for r in before.collect():
        least[r["text"]] = min(r["doc_id"], least.get(r["text"], r["doc_id"]))
    assert sorted(rows(after)) == sorted(least.values())


def test_near_dedup_keeps_one_of_each_group(steps):
    before, after = steps["near_dedup"]
    want = near_brute([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert sorted(rows(after)) == sorted(i for i, (_, _, kept) in want.items() if kept)


def test_mixing_repeats_as_drawn(steps):
    before, after = steps["mixing"]
    docs = before.collect()
    size = defaultdict(int)
    for r in docs:
        size[r["source"]] += len(r["text"] or "")
    weight = {s: math.sqrt(n) for s, n in size.items()}
    total, whole = sum(size.values()), sum(weight.values())
    want = Counter()
    for r in docs:
        rate = weight[r["source"]] / whole * total / size[r["source"]]
        u = (int(hashlib.md5(f"42|{r['doc_id']}|1".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        p = c = math.exp(-rate)
        k = 0
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        want[r["doc_id"]] = k
    assert Counter(r["doc_id"] for r in after.collect()) == +want


def test_packing_holds_every_token_once(steps):
    before, after = steps["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts, copies = {}, Counter()
    for r in before.collect():
        texts[r["doc_id"]] = r["text"] or ""
        copies[r["doc_id"]] += 1
    found, used = Counter(), defaultdict(int)
    for r in after.collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [1]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        found[r["doc_id"]] += r["length"] / len(ids)
        used[r["sequence_id"]] += r["length"]
    assert {i: round(n, 6) for i, n in found.items()} == dict(copies)
    assert max(used.values()) <= 2048


def test_run_is_the_stages_in_order(spark, steps):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == steps["packing"][1].columns
    total = out.agg(F.sum("length").alias("n")).first()["n"]
    assert total == steps["packing"][1].agg(F.sum("length").alias("n")).first()["n"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
