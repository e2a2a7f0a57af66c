import numpy as np
import pytest
from pyspark.sql import functions as F

from dictspark.llm import urlfilter
from dictspark.llm.urlfilter import Rule

RULES = [Rule.of("allow", "com/"), Rule.of("block", "example.com/en/"), Rule.of("allow", "www.example.com/en/"), Rule.of("block", "net/es/"), Rule.of("block", "net/fr/")]


def brute(url, rules, listed):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: (len(r.text), len(r.host)))
        return host, path, best.text, best.verdict
    return host, path, None, "block" if url in listed else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://Example.COM/en/1?x=1", "https://www.example.com/en/", "https://WWW.example.com/en", "http://a.b.net/es/x#y", "http://net/fr/", "http://xnet/fr/",
    "ftp://com", "http://com/", "http://example.org/a://b", "http://spam.org/p?utm_source=1", "http://spam.org/p/#f", "http://spam.org:80/p?b=2&a=1", "http://spam.org/q", "http://notexample.com/en/x",
    "http://user.example.com\n/en/", "x://y?://com/", "http://é.com/en/", "http://spam.org/p?",
]


def test_judgements_against_plain_loops(spark):
    listed = {"http://spam.org/p?utm_source=1", "http://spam.org/p/#f", "http://spam.org/p?"}  # spellings of one listed page
    rows = [(i, u, "own") for i, u in enumerate(URLS)] + [(None, URLS[4], "own"), (4, URLS[4], "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, url_rule string").withColumns({"key": F.lit(1), "HOST": F.lit("h"), "url_judged": F.lit(7), "judged": F.lit(8), "h": F.lit(9)})
    names = spark.createDataFrame([("https://spam.org/p",), (None,), ("",), ("https://spam.org/p",)], "u string")
    got = urlfilter.filter_pages(pages, RULES, names, listed_url="u").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.url_host, r.url_path, r.url_rule, r.url_verdict) == brute(r.url, RULES, listed), r.url
        assert (r.HOST, r.url_judged, r.judged, r.h) == ("h", 7, 8, 9)


def test_ties_and_repeated_rules(spark):
    rules = [Rule.of("block", "b.a.com/"), Rule.of("allow", "a.com/xx"), Rule.of("allow", "z.org/"), Rule.of("block", "z.org/")]
    pages = spark.createDataFrame([("http://b.a.com/xx",), ("http://z.org/",)], "url string")
    got = {r.url: (r.rule, r.verdict) for r in urlfilter.judge(pages, "url", rules).collect()}
    assert got == {"http://b.a.com/xx": ("b.a.com/", "block"), "http://z.org/": ("z.org/", "block")}


def test_empty_tables(spark):
    pages = spark.createDataFrame([("http://a.com/",)], "url string")
    assert urlfilter.filter_pages(pages.limit(0), RULES).count() == 0
    assert urlfilter.judge(pages, "url", [], pages.limit(0)).first().verdict == "allow"
    assert urlfilter.judge(pages, "url", [], pages).first().verdict == "block"


def test_long_lists_and_long_urls(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "SHARD_BYTES", 1024)  # several shards
    urls = [f"http://h{i}.org/p/{'x' * (i % 50)}" for i in range(3000)] + ["http://long.org/" + "y" * 200_000, "http://" + "a." * 500 + "org/en"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert urlfilter.blocks_for(1500) * urlfilter.BLOCK_BITS // 8 > 2 * 1024
    got = urlfilter.filter_pages(pages, RULES, pages.where("page_id % 2 = 0"))
    assert {r.page_id: r.url_verdict for r in got.collect()} == {i: "allow" if i % 2 else "block" for i in range(len(urls))}


def test_filter_has_all_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.xxhash64(F.concat(F.lit("k"), "id")).alias("h"), F.xxhash64(F.concat(F.lit("other"), "id")).alias("o"))
    n_blocks = urlfilter.blocks_for(20_000)
    bloom = urlfilter.build_filter(keys, "h", n_blocks)
    rows = keys.toPandas()
    assert urlfilter.might_contain(bloom, rows.h.to_numpy()).all()
    assert urlfilter.might_contain(bloom, rows.o.to_numpy()).mean() < 0.005
    assert bloom.dtype == np.uint32 and bloom.nbytes <= 20_000 * 3
    blocks = keys.select(urlfilter._block_of(F.col("h"), n_blocks).alias("b")).toPandas().b.to_numpy()
    assert np.array_equal(blocks, urlfilter._places(rows.h.to_numpy(), n_blocks)[0])
    half = rows.h.to_numpy()[blocks >= 500]
    assert np.array_equal(urlfilter.build_filter(keys.where(urlfilter._block_of(F.col("h"), n_blocks) >= 500), "h", n_blocks, 500, n_blocks), bloom[500:])
    assert urlfilter.might_contain(bloom[500:], half, n_blocks, 500).all()


def test_canonical_urls(spark):
    same = ["http://A.com/x/?b=2&a=1#f", "https://a.com:443/x?a=1&utm_medium=q&b=2", "http://a.com/x//?a=1&b=2&&ref=z&ref"]
    got = spark.createDataFrame([(u,) for u in same], "u string").select(urlfilter.canonical(F.col("u"))).distinct().collect()
    assert [r[0] for r in got] == ["a.com/x?a=1&b=2"]
