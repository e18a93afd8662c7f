"""De-duplication rules on FIXTURES rows, plus a property test of the
cross-seen rule against its sequential statement."""

import random

from pyspark.sql import functions as F

from parcorpus.operators import dedup, joins
from parcorpus.plans import views as V
from tests.conftest import SF_SMALL, rows

PAIR = "sl string, tl string, pos long"


def test_clean_corpus(spark):
    df = spark.createDataFrame([("a", "a", 1), ("a", "[ERROR]", 2), ("a", "b", 3), ("a", "b", 4),
                                (None, None, 5)], PAIR)
    assert rows(dedup.clean_corpus(df), "sl", "tl", "pos") == [("a", "b", 3)]


def test_cross_seen(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("a", "y", 3), ("a", "x", 4),
                                ("c", "x", 5)], PAIR)
    got = rows(dedup.cross_seen(df, "sl", "tl").orderBy("pos"), "is_duplicate")
    assert [g[0] for g in got] == [False, False, True, True, False]


def test_split_duplicates_strips(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a ", "x", 2), ("a", "y", 3)], PAIR)
    got = rows(dedup.split_duplicates(df, ["sl", "tl"]).orderBy("pos"), "is_duplicate")
    assert [g[0] for g in got] == [False, True, False]


def test_mark_all_duplicates(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 3), (None, "z", 4),
                                (None, "z", 5)], PAIR)
    got = rows(dedup.mark_all_duplicates(df, ["sl", "tl"]).orderBy("pos"), "is_duplicate")
    assert [g[0] for g in got] == [True, True, False, True, True]


def _sequential_cross_seen(data):
    seen_s, seen_t, out = set(), set(), []
    for s, t in data:
        s, t = s.strip(), t.strip()
        if s in seen_s and t in seen_t:
            out.append(True)
        else:
            seen_s.add(s)
            seen_t.add(t)
            out.append(False)
    return out


def test_cross_seen_property(spark):
    rnd = random.Random(7)
    data = [(rnd.choice("abcde") + rnd.choice(["", " "]), rnd.choice("vwxyz")) for _ in range(400)]
    df = spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(data)], PAIR)
    got = [r[0] for r in dedup.cross_seen(df, "sl", "tl").orderBy("pos").select("is_duplicate").collect()]
    assert got == _sequential_cross_seen(data)


def test_append_corpus_prefers_new(spark):
    new = spark.createDataFrame([("a", "x", 1)], PAIR)
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], PAIR)
    got = rows(joins.append_corpus(new, old).orderBy("gen", "pos"), "gen", "sl", "is_duplicate")
    assert got == [(0, "a", False), (1, "a", True), (1, "b", False)]
    # appending the result again changes nothing (idempotent)
    uniq = dedup.unique_part(joins.append_corpus(new, old)).drop("gen")
    again = dedup.unique_part(joins.append_corpus(new, uniq)).drop("gen")
    assert sorted(rows(again, "sl", "tl")) == sorted(rows(uniq, "sl", "tl"))


def test_global_row_number(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 AS k")
    out = dedup.global_row_number(df.repartition(7), "k")
    got = sorted(rows(out, "k", "rn"))
    assert [r[1] for r in got] == list(range(1, 5001))


def test_global_row_number_of_ties_copies_and_nulls(spark):
    data = [(k % 7 if k % 11 else None, k % 5, "same" if k % 3 else f"t{k}") for k in range(400)]
    df = spark.createDataFrame(data, "k int, j int, text string").repartition(5)
    for order in ("k", ["k", "j"], ["k", "j", "text"]):
        names = [order] if isinstance(order, str) else order
        out = rows(dedup.global_row_number(df, order), "rn", "k", "j", "text")
        assert [r[0] for r in sorted(out)] == list(range(1, 401))
        assert sorted(map(str, (r[1:] for r in out))) == sorted(map(str, data))
        keys = [tuple((r[1 + ["k", "j", "text"].index(c)] is not None, r[1 + ["k", "j", "text"].index(c)]) for c in names)
                for r in sorted(out)]
        assert keys == sorted(keys)
        some = rows(dedup.global_row_number(df, order, keep=F.col("text") == "same"), "rn", "k", "j", "text")
        assert sorted(map(str, some)) == sorted(str(r) for r in out if r[3] == "same")


def test_global_row_number_sorts_and_writes_keys_only(spark, monkeypatch):
    from parcorpus import session
    written = []
    plain = session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name="table": written.append(df.columns) or plain(df, name))
    df = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "pos int, tl string")
    assert dedup.global_row_number(df, "pos").count() == 50
    assert written == [["pos", "_mid", "_pid", "_local"]]


def test_checkpoints_sf0001(spark):
    # first and last line of every document: the input of the survey's values
    dp = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr(
        "doc_id", "lang", "substring_index(text, '\n', 1) src", "substring_index(text, '\n', -1) tgt", "doc_id pos")
    assert dedup.split_duplicates(dp, ["src", "tgt"]).where("is_duplicate").count() == 20
    assert dedup.cross_seen(dp, "src", "tgt").where("is_duplicate").count() == 27
    assert dedup.mark_all_duplicates(dp, ["src", "tgt"]).where("is_duplicate").count() == 37
    assert dp.where("src = tgt").count() == 30


def test_hot_key_third_of_rows(spark):
    """One (source, target) pair holds a third of all rows: the rules stay
    exact and none of them plans a window over the text key."""
    n = 3000
    data = [("hot", "HOT", i) if i % 3 == 0 else (f"s{i % 700}", f"t{i % 500}", i) for i in range(n)]
    df = spark.createDataFrame(data, PAIR).repartition(8)
    f1 = dedup.split_duplicates(df, ["sl", "tl"])
    hot = f1.where("sl = 'hot'")
    assert hot.where("NOT is_duplicate").count() == 1 and hot.count() == n // 3
    assert rows(hot.where("NOT is_duplicate"), "pos") == [(0,)]
    seen = set()
    want = []
    for s, t, _ in data:
        want.append((s, t) in seen)
        seen.add((s, t))
    got = [r[0] for r in f1.orderBy("pos").select("is_duplicate").collect()]
    assert got == want
    kept = dedup.keep_first(df, ["sl", "tl"])
    assert kept.count() == len({(s, t) for s, t, _ in data})
    for out in (f1, dedup.cross_seen(df, "sl", "tl"), dedup.mark_all_duplicates(df, ["sl", "tl"]), kept):
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
