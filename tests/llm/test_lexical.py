import math
import random
import re
from collections import Counter

from parcorpus.llm import lexical
from parcorpus.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, score long, rank string, part int"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lexical.TERM, low)


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in held:
            m = 100 - 75 + 75 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(repr, out))


def ranked(spark, docs, items):
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], KIND)
    it = spark.createDataFrame([(*i, 3) for i in items], "item_id string, text string, rank int")
    return sorted(map(repr, (tuple(r) for r in lexical.rank(df, it).collect())))


def test_rank_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 400)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    monkeypatch.setattr(lexical, "DEPTH", 2)
    rng = random.Random(4)

    def text(n, vocab=80):
        return " ".join(f"w{int(rng.paretovariate(0.6)) % vocab}{rng.choice([',', '.', '', ' -'])}" for _ in range(n))

    docs = [(k, text(rng.choice([1, 5, 20, 60]))) for k in range(250)]
    docs += [(300 + k, "Common words, all ALIKE w3 w4") for k in range(30)]  # ties
    docs += [(3, docs[3][1]), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (400, None), (401, ""), (402, " \n.;"),
             (403, "\u00c9t\u00e9 \u00e9t\u00e9 x\u00c9 w5\u00a0w6 w7"), (404, "w9 " * 60_000)]
    items = [(f"i{k}", text(rng.choice([1, 3, 8, 40]))) for k in range(25)]
    items += [("tie", "alike COMMON"), ("tie", "alike COMMON"), ("none", None), ("blank", " ."), ("absent", "zzz qqq"),
              ("accent", "\u00c9t\u00e9 \u00e9t\u00e9 w6 x\u00c9"), (None, "w1 w1 w1 w2"), ("long", "w9 w9 alike " * 3000)]
    assert ranked(spark, docs, items) == brute(docs, items)


def test_lists_are_read_no_further_than_needed():
    import numpy as np

    n = 100_000
    rng = np.random.default_rng(1)
    doc = np.r_[np.arange(n), np.arange(20)]
    term = np.r_[np.zeros(n, int), np.ones(20, int)]
    tf = np.r_[np.sort(rng.integers(1, 50, n))[::-1], np.full(20, 9)]
    lists = lexical.Lists(np.full(n, 100), doc, term, tf, np.array([1, 5000]), n, 100 * n)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.read += key.stop - key.start
            return np.asarray(self)[key]

    lists.doc = lists.doc.view(Counted)
    docs, scores = lists.best([(0, 1), (1, 1)], 10, np.arange(n))
    exact = np.zeros(n, np.int64)
    for t in (0, 1):
        own = term == t
        exact[doc[own]] += [1, 5000][t] * (1_000_000_000 * tf[own] // (1000 * tf[own] + 800))
    order = np.lexsort((np.arange(n), -exact))[:10]
    assert docs.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert Counted.read < n // 10


def test_empty_tables_and_query(spark):
    docs, items = [(1, "one two")], [("a", "two")]
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None)], items) == []
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op13_lexical_search"](spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == brute(docs, items)
