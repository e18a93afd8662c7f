"""Ranges, splits, batches, requests and the user translation function."""

from pyspark.sql import functions as F

from parcorpus.operators import batching, prep, udf
from tests.conftest import rows


def _ranges(spark, n, mx):
    books = spark.createDataFrame([(1, n)], "book_id int, chapters int")
    return rows(batching.chapter_ranges(books, max_chapters=mx).orderBy("range_index"),
                "start_chapter", "end_chapter")


def test_chapter_ranges_fixture(spark):
    assert _ranges(spark, 50, 20) == [(1, 17), (18, 34), (35, 50)]
    assert _ranges(spark, 20, 20) == [(1, 20)]
    assert _ranges(spark, 150, 30) == [(1, 30), (31, 60), (61, 90), (91, 120), (121, 150)]


def test_chapter_ranges_cover_exactly_once(spark):
    books = spark.createDataFrame([(n, n) for n in range(1, 201)], "book_id int, chapters int")
    r = batching.chapter_ranges(books, max_chapters=30)
    cov = r.select("book_id", F.explode(F.sequence("start_chapter", "end_chapter")).alias("c"))
    assert cov.count() == sum(range(1, 201))
    assert cov.distinct().count() == cov.count()
    sizes = r.groupBy("book_id").agg(F.max(F.col("end_chapter") - F.col("start_chapter")).alias("mx"),
                                     F.min(F.col("end_chapter") - F.col("start_chapter")).alias("mn"))
    assert sizes.where("mx - mn > 1").count() == 0


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(7)], "pos long, t string")
    ex = dict(rows(prep.exact_split(df, ["t"]).groupBy("split").count()))
    assert ex == {"train": 5, "test": 2}
    fl = dict(rows(prep.exact_split(df, ["t"], rule="floor_train").groupBy("split").count()))
    assert fl == {"train": 5, "test": 2}


def test_requests_and_realign_round_trip(spark):
    df = spark.createDataFrame([(i, f"s {i}", f"o {i}") for i in range(95)], "pos long, sl string, ol string")
    b = batching.make_batches(df)
    assert rows(b.groupBy().agg(F.max("batch_id")))[0][0] == 4
    req = batching.make_requests(b)
    assert req.where("n_sentences > 25 OR n_sentences < 1").count() == 0
    back = batching.realign(req.withColumn("translated", F.col("request")))
    assert sorted(rows(back, "sl", "tl")) == sorted((f"s {i}", f"s {i}") for i in range(95))
    broken = batching.realign(req.withColumn("translated", F.lit("only one part")))
    assert {r[0] for r in rows(broken, "tl")} == {"[ERROR]"} and broken.count() == 95


def test_translate_batches_markers(spark):
    df = spark.createDataFrame([(i, f"s{i}", f"o{i}") for i in range(40)], "pos long, sl string, ol string")

    def fn(text):
        if "s3 " in text + " ":
            raise RuntimeError("down")
        return text.upper()

    out = udf.translate_batches(df, fn)
    assert out.count() == 40
    got = rows(out, "batch_id", "chunk_id", "rn", "sl", "tl")
    bad_chunk = {(b, c) for b, c, _, sl, _ in got if sl == "s3"}
    for b, c, rn, sl, tl in got:
        if (b, c) in bad_chunk:
            first = min(r[2] for r in got if (r[0], r[1]) == (b, c))
            # only the first sentence of a failed request keeps the marker;
            # the others equal their source (and fall to drop_untranslated)
            assert tl.startswith("[TRANSLATION FAILED] - ") if rn == first else tl == sl
        else:
            assert tl == sl.upper()


def test_translate_batches_tuple_results(spark):
    df = spark.createDataFrame([(i, f"s{i}", f"o{i}") for i in range(12)], "pos long, sl string, ol string")

    def fn(text):
        parts = [p.strip() for p in text.split("<|||>")]
        return (parts, [p.upper() + " " for p in parts])

    out = udf.translate_batches(df, fn)
    got = rows(out, "sl", "tl", "ol")
    assert sorted(r[0] for r in got) == sorted(f"s{i}" for i in range(12))
    assert all(tl == sl.upper() for sl, tl, _ in got)
    assert all("<|||>" in ol or ol.startswith("s") for _, _, ol in got)


def test_function_runs_once_per_request_and_loses_no_row(spark):
    df = spark.createDataFrame([(i, f"s{i}", f"o{i}") for i in range(90)], "pos long, sl string, ol string")
    calls = spark.sparkContext.accumulator(0)

    def fn(text):
        import random
        calls.add(1)
        parts = [p.strip() for p in text.split("<|||>")]
        return text if random.random() < 0.5 else (parts, parts)

    n = batching.make_requests(batching.make_batches(df)).count()
    out = udf.translate_batches(df, fn)
    got = rows(out, "sl", "batch_id", "chunk_id", "rn")
    assert calls.value == n
    assert sorted(r[0] for r in got) == sorted(f"s{i}" for i in range(90))
    assert len({r[1:] for r in got}) == 90


def test_versions_are_joined_without_a_limit(spark):
    ranges = spark.range(3).withColumnRenamed("id", "range_index")
    versions = spark.range(12_000).selectExpr("cast(id as string) v").union(spark.range(5).selectExpr("cast(id as string) v"))
    out = batching.with_versions(ranges, versions, "v")
    assert out.count() == 36_000 and out.distinct().count() == 36_000


def test_exact_split_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "same")] * 500 + [(2, "same")] * 500, "k int, t string").repartition(7)
    got = sorted(rows(prep.exact_split(df, ["t"]).groupBy("k", "split").count()))
    assert got == [(1, "test", 200), (1, "train", 300), (2, "train", 500)]


def test_answers_of_any_kind(spark):
    """Two lists in a list are pairs as in a tuple; what is neither text nor pairs has failed."""
    from parcorpus.operators import udf
    answers = {"a": [["a1", None], ["b1 ", "b2"]], "b": ("x", "y"), "c": 7, "d": ["one"], "e": None, "f": "F", "g": [["s"], [3]]}
    req = spark.createDataFrame([(k,) for k in answers], "request string")
    got = {r["request"]: (r["translated"], r["pairs"]) for r in udf.translate_requests(req, lambda t: answers[t]).collect()}
    assert [tuple(p) for p in got["a"][1]] == [("a1", "b1"), ("", "b2")] and got["a"][0] is None
    assert got["e"][0] == "[NOT FOUND] - e" and got["f"][0] == "F"
    assert all(got[k] == (f"[TRANSLATION FAILED] - {k}", None) for k in "bcdg")
