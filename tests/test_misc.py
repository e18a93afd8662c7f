"""Small operators: pair-table reader, positional pairing, ordering helpers,
schema helpers, guards and run statistics."""

import tempfile

import pytest

from parcorpus.operators import joins, report, schema
from parcorpus.sources import readers
from tests.conftest import rows


def test_read_pairs(spark):
    d = tempfile.mkdtemp(prefix="parcorpus-pairs-")
    spark.createDataFrame([("a", "x", "m", 1), ("a", "x", "m", 2), (" ", "y", "m", 3), ("b", "z", "m", 4)],
                          "fr string, br string, extra string, pos long").write.mode("overwrite").parquet(d)
    got = sorted(rows(readers.read_pairs(spark, d, "fr", "br", order="pos")))
    assert got == [("a", "x", 1), ("b", "z", 4)]
    with pytest.raises(ValueError):
        readers.read_pairs(spark, d, "fr", "missing")
    assert readers.read_pairs(spark, d, "fr", "missing", on_error="skip") is None
    assert readers.read_pairs(spark, d + "-none", "fr", "br", on_error="skip") is None
    blank = tempfile.mkdtemp(prefix="parcorpus-pairs-")
    spark.createDataFrame([(" ", "y")], "fr string, br string").write.mode("overwrite").parquet(blank)
    with pytest.raises(ValueError, match="no valid pair"):
        readers.read_pairs(spark, blank, "fr", "br")


def test_lead_pair_and_even_then_odd(spark):
    df = spark.createDataFrame([(1, 0, "u0"), (1, 1, "a0"), (1, 2, "u1"), (2, 0, "u")], "g int, i int, v string")
    got = sorted(rows(joins.lead_pair(df, "g", "i", "v"), "g", "i", "v", "next_value"))
    assert got == [(1, 0, "u0", "a0"), (1, 1, "a0", "u1")]
    items = spark.createDataFrame([("even", 0), ("odd", 1), ("even", 2), ("odd", 3)], "cls string, idx int")
    assert [r[0] for r in rows(joins.even_then_odd(items), "idx")] == [0, 2, 1, 3]


def test_schema_helpers(spark):
    df = spark.createDataFrame([("a", "b", "c")], "en_text string, fr_text string, x string")
    assert schema.version_columns(df) == ["en_text", "fr_text"]
    assert schema.ensure_columns(df, ["de_text"], "").columns[-1] == "de_text"
    assert schema.drop_keys(df, ["x", "absent"]).columns == ["en_text", "fr_text"]
    with pytest.raises(ValueError):
        schema.require_columns(df, ["en_text", "niv_text"])
    assert schema.wide_name("KOAD21") == "koad21_text"
    p = schema.add_prompt(spark.createDataFrame([("hi", "br")], "en string, language string"), "double")
    assert p.first()["prompt"] == "translate English to Breton: br: hi"
    assert schema.non_empty_guard(df.where("false"), "skip") is None
    with pytest.raises(ValueError):
        schema.non_empty_guard(df.where("false"))


def test_translation_stats_and_profile(spark):
    t = spark.createDataFrame([("a", "A"), ("b", "[ERROR]"), ("c", "C"), ("d", "[NOT FOUND] - d")],
                              "sl string, tl string")
    st = report.translation_stats(t).first()
    assert (st["total"], st["successful"], st["failed"], st["pct_failed"]) == (4, 2, 2, 50.0)
    empty = report.translation_stats(t.where("false")).first()
    assert empty["total"] == 0 and empty["pct_failed"] is None
    prof = report.table_profile(spark.createDataFrame([("a", None), (" ", "x")], "s string, t string")).first()
    assert (prof["n_rows"], prof["s__blanks"], prof["t__nulls"]) == (2, 1, 1)
    assert (prof["s__type"], prof["s__example"], prof["t__example"]) == ("string", "a", "x")


def test_batch_errors_gate(spark):
    df = spark.createDataFrame([(1, "INFO"), (1, "ERROR"), (2, "INFO")], "batch int, level string")
    errs = report.batch_errors(df)
    assert sorted(rows(errs, "batch", "complete")) == [(1, False), (2, True)]
    assert rows(report.complete_batches(df, errs), "batch") == [(2,)]


def test_missing_sides_are_equal_in_the_anti_join(spark):
    new = spark.createDataFrame([("a", None), ("b", None), (None, None)], "sl string, ol string")
    old = spark.createDataFrame([("a", None), (None, None)], "sl string, ol string")
    assert rows(joins.minus_existing(new, old)) == [("b", None)]
    assert rows(joins.minus_existing(new, old, normalize=True)) == [("b", None)]


def test_newest_per_key_breaks_ties(spark):
    from parcorpus.operators import dedup
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c")], "k string, t int, v string")
    assert rows(dedup.newest_per_key(df, ["k"], "t"), "v") == [("c",)]


def test_split_status(spark):
    from parcorpus.functions import text as TX
    df = spark.createDataFrame([("a <|||> b", 2), ("a", 2), (None, 2)], "t string, n int")
    got = rows(df.select(TX.split_status("t", df["n"]).alias("s")).select("s.status"))
    assert got == [("ok",), ("split_mismatch",), ("missing",)]


def test_checkpoint_folder_must_be_shared(spark):
    from parcorpus import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(type("S", (), {"sparkContext": Context()})())
