import re

import pytest

from eventflow.llm.queries import URL_RULES, op7_url_filter
from eventflow.llm.url_filter import mine_block_rules, url_verdicts
from tests.conftest import SF_SMALL


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def listed(host, path):
    best = None
    for rule, verdict in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


URLS = [None, "", "no scheme", "http://EXAMPLE.com/en/x?y#z", "http://www.example.com/en/", "http://example.com/en", "http://a.net/es/1",
        "x://net/fr/", "http://xnet/fr/", "http://com/", "http://com", "http://com?/a", "a://b://c/d", "http://ÄB.com/ÄB?q", "http://h/a\nb",
        "http://www.example.com.evil.org/en/", "http://a.example.com/EN/", "http://u:p@x.com:80/en/?a=1&b", "http://x" + "/y" * 30_000]


def test_listed_rules_and_split(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[3], "x")], "page_id long, url string, host string")
    rows = url_verdicts(pages, URL_RULES, []).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        url = URLS[3 if r["id"] is None else r["id"]]
        fit = listed(*split(url))
        assert (r["host"], r["path"]) == split(url)
        assert (r["rule"], r["verdict"]) == (fit or (None, "allow"))
    assert url_verdicts(pages.limit(0), URL_RULES, []).collect() == []


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"http://shop{i % 7}.casino-win.org/p/{i}?ref=a", i % 10 > 0) for i in range(200)]
    rows += [(f"http://site{i % 9}.org/{'news' if i % 2 else 'free'}/{i}", i % 20 == 0) for i in range(600)]
    rows += [(f"http://site{i % 9}.org/free/{i}?bonus=1", True) for i in range(60)]
    rows += [("http://site1.org/x", None), (None, True), ("junk", False)]
    return spark.createDataFrame(rows, "url string, blocked boolean")


def test_rules_equal_brute_force_and_are_pruned(spark, labelled):
    from eventflow.llm.url_filter import url_tokens
    from pyspark.sql import functions as F

    rules = dict(mine_block_rules(labelled, min_support=0.02, min_confidence=0.7))
    data = [(set(r["t"]), r["blocked"]) for r in labelled.select(url_tokens(F.col("url")).alias("t"), "blocked").collect()
            if r["blocked"] is not None and (r["t"] or r["blocked"])]
    for tokens, confidence in rules.items():
        hit = [b for t, b in data if tokens <= t]
        assert confidence == pytest.approx(sum(hit) / len(hit)) and confidence >= 0.7
        assert not any(o < tokens and c >= confidence for o, c in rules.items())
    assert any("h:casino" in t for t in rules) and any("q:bonus" in t for t in rules)
    rows = url_verdicts(labelled.withColumn("tokens", url_tokens(F.col("url"))), [], list(rules.items()), "tokens").collect()
    assert len(rows) == labelled.count() and {r["verdict"] for r in rows} == {"allow", "block"}
    for r in rows:
        assert r["verdict"] == ("block" if any(need <= set(r["id"] or ()) for need in rules) else "allow")


def test_no_labels_no_rules(labelled):
    assert mine_block_rules(labelled.limit(0)) == []


def test_query_over_all_pages(spark):
    rows = op7_url_filter(spark, SF_SMALL).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert {r["page_id"] for r in rows} == set(urls)
    for r in rows:
        fit = listed(*split(urls[r["page_id"]]))
        assert r["rule"] == (fit[0] if fit else None)
        assert r["verdict"] == (fit[1] if fit else "block" if r["confidence"] is not None else "allow")


def test_few_rows_and_chance_give_no_rules(spark):
    few = [(f"http://site{i}.org/{i}", i % 4 == 0) for i in range(250)] + [("http://bad.org/x", True)] * 10
    # as many rows as asked for, but no surer than 0.46 (25 of 37 blocked)
    few += [("http://luck.org/y", i < 25) for i in range(37)]
    sure = [("http://casino.org/z", i < 24) for i in range(25)]
    rules = mine_block_rules(spark.createDataFrame(few + sure, "url string, blocked boolean"))
    assert {t for tokens, _ in rules for t in tokens} == {"h:casino", "p:z"}


def test_copies_of_a_url_of_many_tokens_are_mined_as_one(spark):
    words = [chr(97 + i) * 3 for i in range(26)]
    long = "http://one.test/" + "/".join(words) + "?" + "&".join(f"k{w}=1" for w in words)
    rows = [(long, True)] * 30 + [(f"http://site{i}.test/", False) for i in range(40)]
    # as often blocked on both of two items only: a rule of two items, one for each pair of tokens
    rows += [("http://x.org/a1/b1/c1/d1", True)] * 30 + [("http://y.org/a1/b1", False), ("http://z.org/c1/d1", False)] * 15
    rules = dict(mine_block_rules(spark.createDataFrame(rows, "url string, blocked boolean")))
    want = {frozenset([t]) for t in ["h:one", *(f"p:{w}" for w in words), *(f"q:k{w}" for w in words)]}
    want |= {frozenset(["h:x"])} | {frozenset([f"p:{a}", f"p:{b}"]) for a in ("a1", "b1") for b in ("c1", "d1")}
    assert set(rules) == want and set(rules.values()) == {1.0}
