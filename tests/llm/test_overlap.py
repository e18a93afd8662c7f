import random

import brute
from parcorpus.llm import decontam, ngramjoin
from parcorpus.llm.graph import components
from parcorpus.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def text_of(rng, n, vocab=400):
    return " ".join(f"w{rng.randint(0, vocab)}" for _ in range(n))


def edited(rng, t, edits):
    w = t.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randint(0, 9)}"
    return " ".join(w)


def same_components(spark, rows):
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, n int, rid string")
    got = sorted(map(repr, (tuple(r) for r in ngramjoin.similar_documents(df).collect())))
    assert got == sorted(map(repr, brute.components(rows)))


def test_join_matches_brute_force(spark):
    rng = random.Random(2)
    rows, k = [], 10
    for _ in range(25):
        base = text_of(rng, rng.choice([3, 6, 12, 30, 80, 200, 600]))
        for e in (0, 1, 1, 2, 3, 5):
            rows.append((k, edited(rng, base, e) + (" " + text_of(rng, rng.randint(0, 3)) if rng.random() < 0.5 else "")))
            k += 1
    passage = text_of(rng, 60)
    for _ in range(25):
        rows.append((k, text_of(rng, 40) + " " + passage + " " + text_of(rng, 40)))
        k += 1
    rows += [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "one\ttwo\nthree four"), (6, "one two three four"),
             (None, "one two three four"), (None, "lonely words are here now"), (7, "É x"), (8, "é x"), (9, "a " * 30000)]
    same_components(spark, rows)


def test_join_of_chains_needs_the_tree(spark, monkeypatch):
    # a chain of drifting copies: ends are not linked directly, and the bucket's head is near to few
    rng = random.Random(4)
    t = text_of(rng, 150, 5000).split()
    rows = []
    for k in range(60):
        rows.append((k, " ".join(t)))
        t = t[1:] + [f"n{k}"]
    rng.shuffle(rows)
    monkeypatch.setattr(ngramjoin, "LEAF", 8)
    same_components(spark, rows)


def test_join_query_and_empty_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op10_ngram_jaccard"](spark, SF).collect())
    assert got == sorted(brute.components(rows))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngramjoin.similar_documents(empty).count() == 0


def test_difference_bound_of_the_bands():
    for low, r, parts in ngramjoin.bands(85)[:14]:
        high = next(b[0] for b in ngramjoin.bands(85) if b[0] > low)
        worst = max((a + b - 2 * i for b in range(low, high) for a in range(1, b + 1)
                     for i in range(max(0, a * 85 // 100 - 1), a + 1) if 100 * i >= 85 * (a + b - i)), default=0) if high < 150 else r
        assert worst <= r < parts


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}


def test_tiling_matches_its_definition(spark):
    rng = random.Random(6)
    items = [(k, text_of(rng, rng.randint(4, 40), 60)) for k in range(12)] + [(50, None), (51, ""), (52, "one two three four")]
    items += [(53, "a b a b a b a b a b a b")]
    docs = []
    for k in range(60):
        t = items[rng.randrange(12)][1].split()
        cut = rng.randint(0, len(t))
        parts = [t[:cut], t[cut:], text_of(rng, rng.randint(0, 30), 60).split()]
        rng.shuffle(parts)
        docs.append((k, " ".join(sum(parts, []))))
    docs += [(70, None), (71, ""), (72, "A, b! a B a b a; b a b a b."), (72, "A, b! a B a b a; b a b a b."), (None, items[3][1].upper())]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, coverage int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(d), i, round(c, 9)) for d, t in docs for i, x in items if (c := brute.coverage(t, x)) >= 0.5)
    for words in (10 ** 6, 60):
        found = decontam.find_contaminated(df, bench, ["doc_id"], block_words=words).collect()
        assert sorted((str(r["doc_id"]), r["item_id"], round(r["coverage"], 9)) for r in found) == want
        left = decontam.drop_contaminated(df, bench, block_words=words)
        assert left.columns == df.columns
        dirty = {d for d, _, _ in want}
        assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(d) for d, _ in docs if str(d) not in dirty)
    assert decontam.find_contaminated(df, bench.limit(0), ["doc_id"]).count() == 0
    assert decontam.find_contaminated(df.limit(0), bench, ["doc_id"]).count() == 0


def test_reordered_passage_is_caught_and_clean_text_left(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = bench.first()["text"].split()
    half = len(item) // 2
    filler = " ".join(f"clean{i}" for i in range(200))
    docs = spark.createDataFrame([(1, " ".join([filler, *item[half:], filler, *item[:half]])), (2, filler)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()] == [2]


def test_tiling_query(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    whole = {(d, i) for d, t in texts.items() for i, x in items if " ".join(x.split()) in " ".join(t.split())}
    assert whole <= got
    for d, i in got:
        item = dict(items)[i]
        seeds = {tuple(brute.plain_words(item)[k:k + 5]) for k in range(len(brute.plain_words(item)) - 4)}
        w = brute.plain_words(texts[d])
        assert any(tuple(w[k:k + 5]) in seeds for k in range(len(w) - 4))


def test_linked_sets_share_a_signature():
    import numpy as np

    rng = np.random.default_rng(5)
    for percent in (80, 85):
        make = ngramjoin.Shingler(4, percent)
        for n in [*range(1, 80), *rng.integers(80, 9000, 120).tolist()]:
            pool = np.unique(rng.integers(0, 1 << 63, 3 * n + 10, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            pool = rng.permutation(pool)
            # a, and b of any size in reach with the least overlap that still links them
            m = int(rng.integers(-(-percent * n // 100), 100 * n // percent + 1))
            i = -(-percent * (n + m) // (100 + percent))
            if i > min(n, m):
                continue
            a, b = np.sort(pool[:n]), np.sort(np.r_[pool[:i], pool[n:n + m - i]])
            assert 100 * i >= percent * (n + m - i)
            shared = np.intersect1d(make.signatures(a), make.signatures(b))
            assert len(shared) or (n == m == i)


def test_join_of_long_texts_near_the_threshold(spark):
    # texts with more shingles than the fixed parities, around the threshold, and unrelated ones that share passages
    rng = random.Random(8)
    passages = [text_of(rng, 55, 9000) for _ in range(4)]
    rows, k = [], 100
    for words in (1100, 1500, 2100, 4200):
        base = text_of(rng, words, 9000).split()
        for share in (0.0, 0.004, 0.012, 0.018, 0.0185, 0.019, 0.02, 0.024, 0.05):
            t = [f"x{rng.randint(0, 9000)}" if rng.random() < share else w for w in base]
            rows.append((k, " ".join(t[:len(t) - rng.randint(0, 12)])))
            k += 1
        for _ in range(6):
            rows.append((k, " ".join([text_of(rng, words // 2, 9000), *rng.sample(passages, 3), text_of(rng, words // 2, 9000)])))
            k += 1
    rng.shuffle(rows)
    same_components(spark, rows)


def test_growing_parities_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(6)
    make = ngramjoin.Shingler(4, 85)
    for n, m in ((1025, 1025), (1500, 2100), (2040, 2060), (5000, 4400)):
        pool = np.unique(rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64))
        pool = rng.permutation(pool)
        i = min(n, m) - 37
        a, b = np.sort(pool[:n]), np.sort(np.r_[pool[:i], pool[n:n + m - i]])
        x, y = (make.finer(s).view(np.uint64) for s in (a, b))
        short = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(s.reshape(-1, short), axis=0) for s in (x, y))
        assert int(np.bitwise_count(x ^ y).sum()) <= n + m - 2 * i
    assert len(make.finer(np.arange(1024, dtype=np.uint64))) == 0
