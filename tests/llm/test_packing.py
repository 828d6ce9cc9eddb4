import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventflow.llm.packing import ChunkTokenizer, candidates, pack_documents, window_cuts
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def padded(n, window):
    return 0 if n & (n - 1) == 0 else window - n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0.0, 2.0, 5.0])), min_size=1, max_size=40), st.sampled_from([16, 20]))
def test_cuts_have_the_least_cost(steps, window):
    pos = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalty = np.array([0.0] + [p for _, p in steps])
    best = [0.0]
    for i in range(1, len(pos)):
        best.append(min(best[j] + padded(int(pos[i] - pos[j]), window) + penalty[i] + 3.0
                        for j in range(i) if pos[i] - pos[j] <= window))
    cuts, cost = window_cuts(pos, penalty, window, 3.0)
    assert cost == best[-1]
    assert cuts[0] == 0 and cuts[-1] == len(pos) - 1
    lengths = np.diff(pos[cuts])
    assert lengths.max() <= window
    assert cost == sum(padded(int(n), window) + 3.0 for n in lengths) + penalty[cuts[1:]].sum()


ODD = ["", "<|endoftext|>", "X<|ENDOFTEXT|> <|startoftext|>.", "Don't WON'T, it's!?", "J̌̌ é É.", "ΣΑΣ İI ŉ",
       "a1b22 c#$%&&& 漢字。 \t\x0b\x1c\x85　x", "Word, word. WORD!\nword?\n\n"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=40), max_size=4))
def test_chunks_encode_as_the_whole_text(texts):
    library = Tokenizer.from_file(PATH)
    own = ChunkTokenizer(PATH, 1, remember=5)
    for text in texts + ODD:
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids + [1]


def check(rows, docs, window):
    library = Tokenizer.from_file(PATH)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["id"], []).append(r)
    assert set(pieces) == {i for i, _ in docs}
    for i in pieces:
        want = sorted(library.encode(t or "", add_special_tokens=False).ids + [1] for k, t in docs if k == i)
        got, parts = [], sorted(pieces[i], key=lambda r: (r["sequence_id"], r["offset"]))
        for r in parts:
            assert r["length"] == len(r["ids"]) > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            if r["start"] == 0:
                got.append([])
            assert len(got[-1]) == r["start"]
            got[-1] += r["ids"]
        assert sorted(got) == want
        assert {r["doc_tokens"] for r in parts} == {len(w) for w in want}
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    waste = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        waste += padded(end, window)
    return waste, sum(r["length"] for r in rows)


def test_round_trip_nulls_repeats_and_long_texts(spark):
    docs = [(1, None), (2, ""), (3, "a b. c"), (3, "a b. c"), (None, "x"), (4, "word " * 30_000), (5, "End. " * 5000), (6, "z" * 9000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, length string").coalesce(1)
    rows = pack_documents(df, PATH, with_ids=True, block_tokens=3000).collect()
    waste, total = check(rows, docs, 2048)
    assert waste < 0.05 * total
    assert pack_documents(df.limit(0), PATH).collect() == []


def test_little_padding_on_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = pack_documents(df, PATH, with_ids=True).collect()
    waste, total = check(rows, [(r["doc_id"], r["text"]) for r in df.collect()], 2048)
    assert waste < 0.02 * total


def test_every_end_of_short_sentences_may_be_a_cut():
    sentences = np.array([3, 6, 9, 9, 11, 12, 100, 300])
    pos, cost = candidates(400, np.array([200, 400]), sentences, 2048, 4.0, 16.0, 32)
    at = dict(zip(pos.tolist(), cost.tolist(), strict=True))
    assert {p: at[p] for p in sentences.tolist()} == dict.fromkeys(sentences.tolist(), 4.0)
    assert at[0] == at[200] == at[400] == 0.0 and set(at) == {0, 200, 400, *sentences.tolist()}
