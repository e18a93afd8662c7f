"""Merging versions of a text and checking their alignment (G1-G9, G13, J-4, J-6).

Input is the long corpus: one row per (version, book, chapter, verse) entry with
an explicit ``pos`` column giving input order. Every operator is a grouped
aggregation with map-side partial aggregation, so a hot book or chapter is
pre-aggregated before the shuffle; chapter-level facts are small and are
joined back (AQE turns those joins into broadcasts once it has measured them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T
from parcorpus.operators.schema import to_long, wide_name

VERSE_KEY = ["book_name", "chapter", "verse"]
CHAPTER_KEY = ["book_name", "chapter"]

# Length outlier factor of the salvage step (fixed value).
LENGTH_FACTOR = 1.37


def merge_versions(long: DataFrame, versions: Sequence[str], version_col: str = "version",
                   text_col: str = "text", pos_col: str = "pos") -> DataFrame:
    """G1: long entries -> one wide row per (book_name, chapter, verse).

    ``book_id`` comes from the first entry of the group; each version column
    holds the last non-empty text by position, ``""`` when there is none.
    Entries of versions outside the list still produce their key row.
    """
    aggs = [F.min_by("book_id", pos_col).alias("book_id")]
    for v in versions:
        hit = (F.col(version_col) == F.lit(v)) & (F.col(text_col) != F.lit(""))
        aggs.append(F.coalesce(F.max_by(F.when(hit, F.col(text_col)), F.when(hit, F.col(pos_col))),
                               F.lit("")).alias(wide_name(v)))
    return long.groupBy(*VERSE_KEY).agg(*aggs).select(
        "book_name", "book_id", "chapter", "verse", *[wide_name(v) for v in versions])


def merge_stats(long: DataFrame, merged: DataFrame, versions: Sequence[str]) -> DataFrame:
    """Total entries, distinct verse keys, merged rows, rows missing a version."""
    total = long.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    any_empty = F.lit(False)
    for v in versions:
        any_empty = any_empty | (F.col(wide_name(v)) == "")
    # every merged row is one distinct key, so the distinct count equals merged_rows
    return merged.agg(total.alias("total_entries"), F.count(F.lit(1)).alias("unique_verses"),
                      F.count(F.lit(1)).alias("merged_rows"),
                      F.count_if(any_empty).alias("incomplete_rows"))


def _present(wide: DataFrame, versions: Sequence[str]) -> DataFrame:
    """(book_name, chapter, verse, version, text, ordinal) for every non-blank
    stripped text of the wide corpus."""
    long = to_long(wide, VERSE_KEY, [wide_name(v) for v in versions])
    ordinal = F.create_map(*[x for i, v in enumerate(versions) for x in (F.lit(v), F.lit(i))])
    return long.withColumn("ordinal", ordinal[F.col("version")])


def verse_counts(wide: DataFrame, versions: Sequence[str]) -> DataFrame:
    """Per (book, chapter, version) the verses with non-blank text, plus the
    first verse where that version has text (used for tie-breaking)."""
    return (_present(wide, versions)
            .groupBy("book_name", "chapter", "version")
            .agg(F.count(F.lit(1)).alias("n"), F.min("verse").alias("first_verse"),
                 F.min("ordinal").alias("ordinal")))


def _lengths(wide: DataFrame, versions: Sequence[str], *more: str) -> DataFrame:
    """Per row of the wide corpus its key and ``_l``, the length (code points) of each
    version's stripped text, NULL where there is none. No text leaves the row."""
    def length(v: str):
        text = T.strip(F.col(wide_name(v)))
        return F.when(text != "", F.length(text))

    return wide.select(*VERSE_KEY, *more, F.array(*[length(v) for v in versions]).alias("_l"))


def chapter_facts(wide: DataFrame, versions: Sequence[str], factor: float = LENGTH_FACTOR) -> DataFrame:
    """G2-G5 and G7 in one chapter-level table: rows, per-version counts, status,
    majority and outliers, the first suspicious verse and its suspects.

    One aggregation over fixed-width values, combined map-side, so a chapter of any
    size is a row per task: each version's verses, the first of them, and the first
    at which the version is longer than ``mean * factor``. The rest are expressions
    over a chapter's versions, an array bounded by their number, sorted by first
    appearance (first verse with text, then version order).
    The majority is the count with the highest frequency, ties going to the
    count met first; outliers are the versions whose count differs, in order
    of first appearance; ``counts`` lists (version, n) ascending by n, ties in
    first-appearance order. The split verse is the first at which an outlier is too
    long, and the suspects are those that are so there. Chapters with no text at
    all are ``empty``."""
    rows = _lengths(wide, versions)
    own = F.filter("_l", lambda x: x.isNotNull())
    rows = rows.select(*CHAPTER_KEY, "verse", "_l", F.size(own).alias("_n"),
                       F.aggregate(own, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("_sum"))
    rows = rows.select(*CHAPTER_KEY, "verse", "_l", F.when(F.col("_n") >= 2, F.col("_sum") / F.col("_n") * F.lit(float(factor))).alias("_most"))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i in range(len(versions)):
        length = F.get("_l", F.lit(i))
        aggs += [F.count(length).alias(f"_n{i}"), F.min(F.when(length.isNotNull(), F.col("verse"))).alias(f"_f{i}"),
                 F.min(F.when(length > F.col("_most"), F.col("verse"))).alias(f"_s{i}")]
    found = rows.groupBy(*CHAPTER_KEY).agg(*aggs)
    by_version = F.array(*[F.struct(
        F.col(f"_f{i}").alias("first_verse"), F.lit(i).alias("ordinal"), F.lit(v).alias("version"), F.col(f"_n{i}").alias("n"),
        F.col(f"_s{i}").alias("long")) for i, v in enumerate(versions)])
    found = found.select(*CHAPTER_KEY, "n_rows", F.array_sort(F.filter(by_version, lambda x: x["n"] > 0)).alias("_a"))
    a = F.col("_a")
    found = found.select(*CHAPTER_KEY, "n_rows", "_a", F.transform(
        a, lambda x: F.size(F.filter(a, lambda y: y["n"] == x["n"]))).alias("_freqs"))
    found = found.select(*CHAPTER_KEY, "n_rows", "_a", F.element_at(
        a, F.array_position("_freqs", F.array_max("_freqs")).cast("int"))["n"].alias("majority"))
    found = found.select(*CHAPTER_KEY, "n_rows", "_a", "majority",
                         F.filter(a, lambda x: x["n"] != F.col("majority")).alias("_out"))
    found = found.select("*", F.array_min(F.transform("_out", lambda x: x["long"])).alias("split_verse"))
    return found.select(
        *CHAPTER_KEY, "n_rows", F.size(a).cast("long").alias("n_versions"),
        F.when(F.size(a) == 0, F.lit("empty")).when(F.size("_out") == 0, F.lit("consistent"))
        .otherwise(F.lit("inconsistent")).alias("status"),
        "majority",
        F.transform(F.array_sort(F.transform(a, lambda x: F.struct(
            x["n"].alias("n"), x["first_verse"].alias("f"), x["ordinal"].alias("o"),
            x["version"].alias("version")))),
            lambda x: F.struct(x["version"].alias("version"), x["n"].alias("n"))).alias("counts"),
        F.transform("_out", lambda x: x["version"]).alias("outliers"), "split_verse",
        F.transform(F.array_sort(F.transform(
            F.filter("_out", lambda x: x["long"] == F.col("split_verse")),
            lambda x: F.struct(x["ordinal"].alias("o"), x["version"].alias("version")))),
            lambda x: x["version"]).alias("suspects"))


def chapter_status(wide: DataFrame, versions: Sequence[str]) -> DataFrame:
    """Per chapter ``consistent`` (all present versions have the same
    count, one version counts as consistent), ``inconsistent``, or ``empty``
    (no text in any version)."""
    return chapter_facts(wide, versions).select(*CHAPTER_KEY, "n_rows", "n_versions", "status")


def label_chapters(wide: DataFrame, status: DataFrame, col: str = "status") -> DataFrame:
    """J-4: attach the chapter status to each row (one label instead of two
    semi/anti joins); ``empty`` chapters route to the inconsistent output."""
    return wide.join(status.select(*CHAPTER_KEY, F.col("status").alias(col)), CHAPTER_KEY, "left")


def majority_outliers(wide: DataFrame, versions: Sequence[str]) -> DataFrame:
    """G4/G5/L6 per inconsistent chapter: counts sorted ascending, majority
    count (ties: the count met first, i.e. of the version whose first text
    comes earliest, then by version order) and outlier versions in order of
    first appearance."""
    return chapter_facts(wide, versions).where(F.col("status") == "inconsistent").select(
        *CHAPTER_KEY, "majority", "counts", "outliers")


def verse_length_stats(wide: DataFrame, versions: Sequence[str]) -> DataFrame:
    """Per verse with at least two present versions, the mean length (code
    points) of the stripped texts."""
    present = _present(wide, versions)
    return (present.groupBy(*VERSE_KEY)
            .agg(F.count(F.lit(1)).alias("n_versions"),
                 F.avg(F.length("text")).alias("mean_len"))
            .where(F.col("n_versions") >= 2))


def _named(lengths, versions: Sequence[str]):
    """ARRAY<STRUCT<version, len>> of the versions that have a length, in their order."""
    both = F.zip_with(F.array(*[F.lit(v) for v in versions]), lengths,
                      lambda v, n: F.struct(v.alias("version"), n.alias("len")))
    return F.filter(both, lambda x: x["len"].isNotNull())


def suspicious_verses(wide: DataFrame, versions: Sequence[str], factor: float = LENGTH_FACTOR) -> DataFrame:
    """Per inconsistent chapter the first verse where an outlier version is
    longer than ``mean * factor`` (strict; the mean includes it), with the
    suspect versions and every version's length at that verse.

    The verses come from the chapter aggregate; the lengths from the corpus' row
    with that key, by a join over keys and lengths."""
    split = chapter_facts(wide, versions, factor).where("split_verse is not null").select(
        *CHAPTER_KEY, F.col("split_verse").alias("verse"), "suspects")
    return _lengths(wide, versions).join(split, VERSE_KEY).select(
        *CHAPTER_KEY, F.col("verse").alias("split_verse"), "suspects", _named(F.col("_l"), versions).alias("lengths"))


def salvage(wide: DataFrame, versions: Sequence[str], factor: float = LENGTH_FACTOR,
            col: str = "label") -> DataFrame:
    """G8 + J-6: label every row of the wide corpus ``good`` or ``suspect``.

    Consistent chapters and inconsistent chapters without a suspicious verse are
    good as a whole; otherwise verses before the split are good and the rest
    suspect. Chapters with no text at all are left out. One join with the chapter
    aggregate.
    """
    facts = chapter_facts(wide, versions, factor).where("status <> 'empty'").select(*CHAPTER_KEY, "split_verse")
    lab = F.when(F.col("split_verse").isNull() | (F.col("verse") < F.col("split_verse")),
                 F.lit("good")).otherwise(F.lit("suspect"))
    return wide.join(facts, CHAPTER_KEY, "inner").withColumn(col, lab).drop("split_verse")


def alignment_report(wide: DataFrame, versions: Sequence[str], factor: float = LENGTH_FACTOR) -> DataFrame:
    """One row per inconsistent chapter with everything the text report
    states: counts (ascending), majority, outliers, split verse, the sizes of
    both sides, suspects and lengths at the split verse.

    The chapter aggregate is joined with the keys and lengths of the corpus once,
    which counts both sides of the split and finds its lengths."""
    facts = chapter_facts(wide, versions, factor).where("status = 'inconsistent'").drop("n_rows", "n_versions", "status")
    here = F.col("verse") == F.col("split_verse")
    sides = _lengths(wide, versions).join(facts.where("split_verse is not null").select(*CHAPTER_KEY, "split_verse"), CHAPTER_KEY).groupBy(
        *CHAPTER_KEY).agg(
        F.count_if(F.col("verse") < F.col("split_verse")).alias("n_good"),
        F.count_if(F.col("verse") >= F.col("split_verse")).alias("n_suspect"),
        *[F.max(F.when(here, F.get("_l", F.lit(i)))).alias(f"_l{i}") for i in range(len(versions))])
    sides = sides.select(*CHAPTER_KEY, "n_good", "n_suspect", _named(
        F.array(*[F.col(f"_l{i}") for i in range(len(versions))]), versions).alias("lengths"))
    return facts.join(sides, CHAPTER_KEY, "left").select(
        *CHAPTER_KEY, "counts", "majority", "outliers", "split_verse", "n_good", "n_suspect",
        F.when(F.col("split_verse").isNotNull(), F.col("suspects")).alias("suspects"), "lengths")


def report_text(report: DataFrame) -> DataFrame:
    """Readable block per chapter from :func:`alignment_report`."""
    counts = F.array_join(F.transform("counts", lambda x: F.concat(
        F.lit("'"), x["version"], F.lit("_text': "), x["n"].cast("string"))), ", ")
    lines = [
        F.concat_ws(" ", "book_name", F.col("chapter").cast("string")),
        F.concat(F.lit("Verse counts per version: {"), counts, F.lit("}")),
        F.concat(F.lit("Majority has "), F.col("majority").cast("string"), F.lit(" verses")),
        F.concat(F.lit("Outlier versions (wrong count): "), F.array_join("outliers", ", ")),
        F.when(F.col("split_verse").isNull(),
               F.lit("  -> No suspicious merge detected - whole chapter to good prefix"))
        .otherwise(F.concat(F.lit("  -> Split at verse "), F.col("split_verse").cast("string"),
                            F.lit(" (good prefix: "), F.col("n_good").cast("string"),
                            F.lit(", suffix: "), F.col("n_suspect").cast("string"),
                            F.lit(", suspects: "), F.array_join("suspects", ", "), F.lit(")"))),
    ]
    return report.select(*CHAPTER_KEY, F.concat_ws("\n", *lines).alias("report"))


def version_books(long: DataFrame, version_col: str = "version") -> DataFrame:
    """One row per version and book with the book's entries, and the
    version's entries and number of books on each (its books are its rows)."""
    books = long.groupBy(version_col, "book_name").agg(F.count(F.lit(1)).alias("book_entries"))
    totals = books.groupBy(version_col).agg(
        F.sum("book_entries").alias("entries"), F.count(F.lit(1)).alias("n_books"))
    return books.join(totals, version_col)


def with_book_order(df: DataFrame, books: DataFrame, id_col: str = "book_id",
                    ord_col: str = "book_ord") -> DataFrame:
    """J-3: book ordinal from the book dimension, -1 when unknown."""
    dim = books.select(F.col("id").alias(id_col), F.col("ordinal").alias(ord_col))
    return df.join(dim, id_col, "left").withColumn(ord_col, F.coalesce(F.col(ord_col), F.lit(-1)))


def canonical_sort(df: DataFrame, books: DataFrame) -> DataFrame:
    """L1: (book order, chapter, verse), range-partitioned sort."""
    return with_book_order(df, books).orderBy("book_ord", "chapter", "verse")


def range_label(df: DataFrame, splits: DataFrame, col: str = "side") -> DataFrame:
    """J-6: verses before the chapter's split -> prefix, from it on -> suffix;
    chapters without a split are all prefix."""
    j = df.join(splits.select(*CHAPTER_KEY, "split_verse"), CHAPTER_KEY, "left")
    return j.withColumn(col, F.when(F.col("split_verse").isNull()
                                    | (F.col("verse") < F.col("split_verse")), F.lit("prefix"))
                        .otherwise(F.lit("suffix"))).drop("split_verse")

