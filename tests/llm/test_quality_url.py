import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from parcorpus.llm import quality, urlfilter
from parcorpus.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"
EDGE = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "w " * 70000, "b"), (5, "x y z x y z", "a"),
        (6, "L one\nL one\n \nL one", "a"), (6, "L one\nL one\n \nL one", "a"), (None, "été ## $%", None),
        (7, " ".join(f"t{i}" for i in range(60)), "c"), (8, " ".join(f"u{i}" for i in range(49)), "c")]


def test_measures_and_hosts_match_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1, True) for r in EDGE], "doc_id long, text string, source string, n_words int, kept boolean")
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    for df in (docs, real):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
        bad = brute.host_rejected([(h, t) for _, t, h in rows])
        want = sorted(repr((d, *brute.measure(t), not brute.measure(t)[-1] and h not in bad)) for d, t, h in rows)
        got = quality.judge(df, columns=["doc_id"]).drop("host_rate").collect()
        assert sorted(repr(tuple(r)) for r in got) == want


def test_bad_host_is_rejected_and_small_one_shrunk(spark):
    good = " ".join(f"g{i}" for i in range(80))
    rows = [(i, good, f"ok{i % 10}") for i in range(200)] + [(1000 + i, "spam", "bad") for i in range(60)]
    rows += [(2000, good, "bad"), (3000, "short", "tiny"), (3001, good, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality.keep_good(df).collect()}
    assert 2000 not in kept and 3001 in kept and len(kept) == 201


def test_keep_good_keeps_columns_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, _doc int, n_words string")
    assert quality.keep_good(df).columns == df.columns and quality.keep_good(df).count() == 0


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.com/en/a", "https://www.example.com/en/x?y#z", "http://a.net/es/q",
        "http://net/fr/", "http://x.org?u=/p", "http://x.org#f", "http://b.example.com/en", "ftp://com", "http://Ünï.com/Ä",
        "http://notexample.com/en/", "http://bad.org/p/?utm_source=a&b=2&a=1", "http://bad.org:80/p?a=1&b=2#t", "x://bad.org/p",
        "http://bad.org/p?a=1&b=2", "http://bad.org/p?a=1&b=2"]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[k:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k])
    return host, path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    listed = spark.createDataFrame([("https://bad.org/p?b=2&a=1",), (None,), ("http://www.example.com/en/x?y",)], "url string")
    got = {r["page_id"]: r for r in urlfilter.judge_urls(pages, listed, URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path = plain(u)
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1] if fits else None
        verdict = max(fits)[2] if fits else ("block" if u and "bad.org" in u and u != "x://bad.org/p" else "allow")
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict), u
    assert {r["verdict"] for r in urlfilter.judge_urls(pages, listed.limit(0), [], id_col="page_id").collect()} == {"allow"}
    assert urlfilter.judge_urls(pages.limit(0), listed, URL_RULES).count() == 0


def test_bloom_filter_has_no_false_negative(spark):
    rng = random.Random(3)
    keys = spark.createDataFrame([(f"k{rng.random()}",) for _ in range(3000)], "k string")
    blocks = urlfilter.bloom_blocks(keys, "k")
    assert urlfilter.with_maybe(keys, "k", blocks).where("not _maybe").count() == 0
    others = spark.range(3000).select(F.concat(F.lit("o"), "id").alias("k"))
    assert urlfilter.with_maybe(others, "k", blocks).where("_maybe").count() < 30


def canonical(url):
    host, path = plain(url)
    host = host[:-3] if host.endswith(":80") else host[:-4] if host.endswith(":443") else host
    rest = url.split("://", 1)[1].split("#")[0] if url and "://" in url else ""
    asked = rest.split("?", 1)[1].split("&") if "?" in rest else []
    kept = sorted(q for q in asked if q and not re.match("(utm_[a-z]+|ref|fbclid|gclid)=", q))
    return host + path.rstrip("/") + ("?" + "&".join(kept) if kept else "") if host else None


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_url_query_matches_brute_force(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()
    first, listed = {}, set()
    for r in sorted(pages, key=lambda r: r["page_id"]):
        title = re.search("<title>([^<]*)</title>", r["html"] or "")
        if title and title[1]:
            if first.setdefault(title[1], r["page_id"]) != r["page_id"]:
                listed.add(canonical(r["url"]))
    want = []
    for r in pages:
        host, path = plain(r["url"])
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        verdict = max(fits)[2] if fits else "block" if canonical(r["url"]) in listed - {None} else "allow"
        want.append((r["page_id"], host, path, max(fits)[1] if fits else None, verdict))
    got = [tuple(r) for r in QUERIES["op2_url_filter"](spark, f"/root/testdata/{sf}").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # the list decides: pages without a rule are blocked
    assert sum(r[3] is None and r[4] == "block" for r in got) >= (400 if sf == "sf0.1" else 1)


def test_mirrors_bear_edges(spark):
    rows = [(1, "http://a.org/1", "<title>T</title>"), (2, "http://a.org/2", "<title>T</title>"), (2, "http://a.org/2", "<title>T</title>"),
            (3, "http://a.org/3", "<title></title>"), (4, "http://a.org/4", None), (None, "http://a.org/5", "<title>T</title>"),
            (6, None, "<title>T</title>"), (7, "http://a.org/7", "x" * 100000 + "<title>U\nV</title>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, _id string")
    assert sorted(str(r["url"]) for r in urlfilter.mirrors(df).collect()) == ["None", "http://a.org/2", "http://a.org/2"]
    assert urlfilter.mirrors(df.limit(0)).count() == 0


def test_filter_grows_with_the_list(spark):
    assert urlfilter.log2_blocks(0) == urlfilter.log2_blocks(1 << 20) == 16 and urlfilter.log2_blocks((1 << 20) + 1) == 17
    assert urlfilter.log2_blocks(10 ** 9) >= 26
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"))
    log2 = urlfilter.LOG2_SENT + 1  # one that is shuffled
    blocks = urlfilter.bloom_blocks(keys, "k", log2)
    hot = keys.unionByName(spark.range(1000).select(F.lit("k7").alias("k"))).unionByName(spark.range(3000).select(F.concat(F.lit("o"), "id").alias("k")))
    got = urlfilter.with_maybe(hot, "k", blocks, log2=log2)
    assert got.count() == 6000 and got.where("not _maybe and k like 'k%'").count() == 0 and got.where("_maybe and k like 'o%'").count() < 30


def test_hosts_differ_under_a_stricter_rate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.judge(docs, columns=["doc_id", "source"])
    rates = sorted({r["host_rate"] for r in judged.select("host_rate").distinct().collect() if r["host_rate"] is not None})
    between = (rates[0] + rates[-1]) / 2
    assert rates[0] < between < rates[-1]
    strict = quality.judge(docs, columns=["doc_id", "source"], max_rate=between)
    gone = strict.where("not kept and not base_failed")
    assert gone.count() > 0 and gone.where(F.col("host_rate") <= between).count() == 0
    assert strict.where("kept").count() > 0
