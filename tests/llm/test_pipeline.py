import random
from functools import partial

import public_tokenizers as P
import tiktoken

import brute
import corpus_pipeline
from parcorpus.llm import bpe
from test_lines_chat_shards import keyed
from test_overlap import edited, text_of

SF = "/root/testdata/sf0.001"


def brute_run(spark, docs, items):
    bad = brute.host_rejected([(s, t) for _, t, s in docs])
    docs = [(d, t, s) for d, t, s in docs if not brute.measure(t)[-1] and s not in bad]
    done = brute.dedup_lines([(d, t) for d, t, _ in docs], keyed(spark, [(d, t) for d, t, _ in docs]))
    docs = [(d, done[d, t][0], s) for d, t, s in docs if not 0 < done[d, t][1] <= done[d, t][2]]
    least = {d: c for d, _, c in brute.components([(d, t) for d, t, _ in docs])}
    docs = [x for x in docs if least[x[0]] == x[0]]
    seeds = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, x in items if (w := brute.plain_words(x))}
    out = []
    for d, t, _ in docs:
        w = brute.plain_words(t)
        own = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        if not any(own & seeds[i] and brute.coverage(t, x) >= 0.5 for i, x in items if i in seeds):
            out.append((d, t))
    return out


def test_run_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))))
    want = {d: own.encode_ordinary(t) for d, t in brute_run(spark, docs, items)}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 50 < len(got) < len(docs)


def test_stages_keep_columns_and_bear_edges(spark):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (None, text + " x", "en", "s", 2), (3, "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == docs.columns
            df = out
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() <= 3


def test_near_duplicates_go_by_row(spark):
    def words(a, n):
        return " ".join(f"{a}{i}" for i in range(n))

    one, two, three, four = (words(a, 90) for a in "abcd")
    rows = [(1, one, 1), (1, one, 1), (1, one, 1), (None, one, 2),  # copies of a row, and one without an id
            (None, two, 3), (None, two + " x", 3), (None, two, 3),  # a group without ids
            (7, three, 4), (9, three + " x", 5), (9, four, 6),  # an id on a near copy and on a text of its own
            (None, None, 7), (None, None, 7), (8, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    for parts in (1, 5):
        out = corpus_pipeline.near_duplicates(spark, docs.repartition(parts), SF)
        got = [tuple(r) for r in out.collect()]
        assert out.columns == docs.columns and all(r in rows for r in got)
        of_two = [r for r in got if r[1] in (two, two + " x")]
        assert len(of_two) == 1
        assert sorted(map(repr, (r for r in got if r not in of_two))) == sorted(map(repr, [
            (1, one, 1), (7, three, 4), (9, four, 6), (None, None, 7), (None, None, 7), (8, "", 8)]))


def test_equal_rows_leave_one_through_all_stages(spark):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(1, text, "en", "s", 1)] * 3 + [(None, text + " x", "en", "s", 2)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
    assert [r["doc_id"] for r in df.collect()] == [1]


def at_stage_threshold(monkeypatch):
    monkeypatch.setattr(brute, "shingles", partial(brute.shingles, k=5))
    monkeypatch.setattr(brute, "components", partial(brute.components, percent=80))


def test_near_copies_of_five_words_from_80_percent_go(spark, monkeypatch):
    # four words of 190 differ: 0.806 on five words, 0.842 on four
    base = [f"w{i}" for i in range(190)]
    near = [f"x{i}" if i in (30, 70, 110, 150) else w for i, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(near))]
    assert brute.components(rows)[1][2] == 2
    rng = random.Random(8)
    for _ in range(25):
        t = text_of(rng, rng.choice([4, 5, 6, 12, 40, 90, 200, 500]), 4000)
        rows += [(len(rows) + k, edited(rng, t, rng.randint(0, 1 + len(t.split()) // 45))) for k in range(1, 6)]
    at_stage_threshold(monkeypatch)
    want = sorted(d for d, _, least in brute.components(rows) if d == least)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert got == want and 2 not in got and 25 < len(got) < len(rows)


def test_run_matches_brute_force_at_stage_threshold(spark, monkeypatch):
    at_stage_threshold(monkeypatch)
    test_run_matches_brute_force(spark)
