import random
import re
import zlib
from collections import Counter

import numpy as np

from eventflow.llm import spelling_variants as sv


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, factor=10):
    """{word: (n, n_near, form, form_n, root)}"""
    form, out = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
        out[w] = [n, len(close), form[w], counts[form[w]] if form[w] else None]
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (*out[w], root)
    return out


def grouped(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def brute_runs(docs, least=7, every=None):
    words = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                words[w] += 1
    return words


def vocabulary(seed, n):
    rng = random.Random(seed)
    letters = "abcé"
    counts = {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))
        counts[w] = rng.choice([1, 2, 3, 25, 40, 400, 5000])
    return counts


def test_neighbourhoods_are_whole():
    for symbols in (2, 3, 8):
        rng = random.Random(symbols)
        for size in (0, 1, 2, 5, 9):
            word = "".join(rng.choice("abcdefgh") for _ in range(size))
            reduced = sv.symbols_of([word], symbols)
            hashes = set(sv.neighbourhoods(reduced, symbols)[0].tolist())
            own = [int(x) for x in reduced[0]]
            every = range(1, symbols + 1)
            strings = {tuple(own)}
            strings |= {tuple(own[:i] + own[i + 1 :]) for i in range(size)}
            strings |= {tuple(own[:i] + [s] + own[i + 1 :]) for i in range(size) for s in every}
            strings |= {tuple(own[:i] + [s] + own[i:]) for i in range(size + 1) for s in every}
            expected = set()
            for s in strings:
                h = 0
                for j, x in enumerate(s):
                    h = (h + x * pow(sv.BASE, j, 1 << 64)) % (1 << 64)
                expected.add(int(sv.mixed(np.array([h], np.uint64))[0]))
            assert hashes == expected and len(expected) == len(strings)


def test_equals_brute_force(spark):
    for seed, symbols, bits in ((1, 2, 1 << 6), (2, 8, 1 << 20), (3, 3, 1 << 26)):
        counts = vocabulary(seed, 250)
        frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
        assert grouped(sv.variant_groups(frame, symbols=symbols, filter_bits=bits)) == brute(counts)


def test_chains_ties_nulls_and_repeats(spark):
    rows = [("kitchens", 2), ("kitchenz", 30), ("kitchenzz", 400), ("kitchenzzz", 9000), ("kitchenzzzz", 200_000), ("lonelyword", 5),
            ("settings", 2), ("setting", 50), ("settingz", 50), ("transpose", 3), ("trasnpose", 300), ("straße", 1), ("strasse", 90), ("strase", 20),
            ("long" + "x" * 3000, 2), ("long" + "x" * 2999, 20), ("", 4), ("a", 50), (None, 9)]
    frame = spark.createDataFrame([(w, n, 1) for w, n in rows] + [("lonelyword", 3, 1)], "word string, n long, form int")
    counts = dict(r for r in rows if r[0] is not None) | {"lonelyword": 8}
    got = grouped(sv.variant_groups(frame))
    assert got == brute(counts)
    assert got["kitchens"][4] == "kitchenzzzz" and got["settings"][2] == "setting" and got["transpose"][1] == 0


def test_runs_and_slips_equal_brute_force(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choice(["Straßenbahn", "überALLES", "naïveté", "MÜLLEREI", "abcdefg", "ÿÿÿÿÿÿÿÿ", "a1bcdefghi", "x×y÷zabcd", "short"])
                         for _ in range(rng.randint(0, 40)))) for i in range(120)]
    docs += [(None, "Straßenbahn abcdefgh"), (500, None), (501, ""), (502, "z" * 50_000)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string").repartition(3)
    for every in (None, 31, 2):
        counted = {r.word: r.n for r in sv.word_counts(sv.letter_runs(frame, slip_every=every), least=1).collect()}
        assert counted == brute_runs(docs, every=every)


def test_empty(spark):
    frame = spark.createDataFrame([], "word string, n long")
    assert sv.variant_groups(frame).collect() == []
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sv.letter_runs(docs, slip_every=31).collect() == []
