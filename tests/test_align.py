"""Version merge and alignment checks: FIXTURES rows and the sf0.001 checkpoints."""

from pyspark.sql import functions as F

from parcorpus.operators import align
from parcorpus.plans import views as V
from tests.conftest import SF_SMALL, rows

LONG = "version string, book_id int, book_name string, chapter int, verse int, text string, pos long"


def test_merge_last_non_empty_wins(spark):
    long = spark.createDataFrame([
        ("v1", 1, "B", 1, 1, "p", 1), ("v1", 1, "B", 1, 1, "q", 2), ("v1", 1, "B", 1, 1, "", 3),
        ("v2", 1, "B", 1, 1, "r", 4), ("v9", 7, "C", 1, 1, "z", 5)], LONG)
    got = rows(align.merge_versions(long, ["v1", "v2", "v3"]).orderBy("book_name"))
    assert got == [("B", 1, 1, 1, "q", "r", ""), ("C", 7, 1, 1, "", "", "")]


def _wide_from_counts(spark, counts, lengths=None):
    """Wide rows of one chapter where version v has text on verses 1..counts[v]."""
    versions = list(counts)
    n = max(max(counts.values()), 1) if counts else 1
    data = []
    for verse in range(1, n + 1):
        texts = []
        for v in versions:
            if verse <= counts[v]:
                ln = (lengths or {}).get((verse, v), 10)
                texts.append("x" * ln)
            else:
                texts.append("")
        data.append(("B", 1, 1, verse, *texts))
    cols = ", ".join(f"{v}_text string" for v in versions)
    return spark.createDataFrame(data, f"book_name string, book_id int, chapter int, verse int, {cols}"), versions


def test_chapter_status(spark):
    for counts, want in [({"v1": 3, "v2": 3}, "consistent"), ({"v1": 3}, "consistent"),
                         ({"v1": 3, "v2": 2}, "inconsistent")]:
        wide, vs = _wide_from_counts(spark, counts)
        assert rows(align.chapter_status(wide, vs), "status") == [(want,)]
    wide, vs = _wide_from_counts(spark, {"v1": 0, "v2": 0})
    assert rows(align.chapter_status(wide, vs), "status") == [("empty",)]


def test_majority_tie_takes_first_seen(spark):
    # v2 has text first (verse 1) while v1 starts at verse 2 -> v2's count wins the tie
    data = [("B", 1, 1, 1, "", "a"), ("B", 1, 1, 2, "a", "a"), ("B", 1, 1, 3, "a", ""),
            ("B", 1, 1, 4, "a", "")]
    wide = spark.createDataFrame(data, "book_name string, book_id int, chapter int, verse int, "
                                       "v1_text string, v2_text string")
    mo = align.majority_outliers(wide, ["v1", "v2"]).first()
    assert mo["majority"] == 2 and mo["outliers"] == ["v1"]


def test_first_suspicious_verse(spark):
    # v2 is the outlier (fewer verses). lengths v1 = 10, v2 = 21: mean 15.5, limit 21.235 -> none
    wide, vs = _wide_from_counts(spark, {"v1": 3, "v2": 2}, {(1, "v2"): 21})
    assert align.suspicious_verses(wide, vs).count() == 0
    wide, vs = _wide_from_counts(spark, {"v1": 3, "v2": 2}, {(1, "v2"): 40})
    sv = align.suspicious_verses(wide, vs).first()
    assert sv["split_verse"] == 1 and sv["suspects"] == ["v2"]
    lab = align.salvage(wide, vs)
    assert rows(lab.groupBy("label").count().orderBy("label")) == [("suspect", 3)]


def test_limit_is_strict(spark):
    # two versions 10 and 22 in an inconsistent chapter: mean 16, limit 21.92 -> 22 is suspicious
    wide, vs = _wide_from_counts(spark, {"v1": 3, "v2": 2}, {(2, "v1"): 10, (2, "v2"): 22})
    sv = align.suspicious_verses(wide, vs).collect()
    assert [r["split_verse"] for r in sv] == [2]


def test_checkpoints_sf0001(spark):
    long = V.verses_long(spark, SF_SMALL)
    assert long.count() == 1829
    wide = align.merge_versions(long, V.VERSIONS)
    st = align.merge_stats(long, wide, V.VERSIONS).first()
    assert (st["merged_rows"], st["incomplete_rows"]) == (876, 867)
    status = align.chapter_status(wide, V.VERSIONS)
    agg = {r["status"]: (r["n"], r["r"]) for r in
           status.groupBy("status").agg(F.count("*").alias("n"), F.sum("n_rows").alias("r")).collect()}
    assert agg == {"consistent": (8, 174), "inconsistent": (32, 702)}
    assert align.suspicious_verses(wide, V.VERSIONS).count() == 30
    lab = dict(rows(align.salvage(wide, V.VERSIONS).groupBy("label").count()))
    assert lab == {"good": 223, "suspect": 653}
