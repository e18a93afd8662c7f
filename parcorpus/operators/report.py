"""Run statistics and readable exports.

All are single aggregations (partial + final) or per-chapter collections whose
size is bounded by one chapter; nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T


def _pct(part, total) -> F.Column:
    return F.when(total > 0, F.round(F.lit(100.0) * part / total, 1))


def pair_counts(pairs: DataFrame, language: str = "language") -> DataFrame:
    """Valid pairs per language (the total is their sum)."""
    return pairs.groupBy(language).agg(F.count(F.lit(1)).alias("n_pairs"))


def translation_stats(df: DataFrame, tl: str = "tl") -> DataFrame:
    """Total, successful (not starting with a marker), failed and their
    percentages to one decimal; NULL percentages when there are no rows."""
    failed = T.is_failed(tl)
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(~failed).alias("successful"),
                 F.count_if(failed).alias("failed"))
    return agg.select("total", "successful", "failed",
                      _pct(F.col("successful"), F.col("total")).alias("pct_successful"),
                      _pct(F.col("failed"), F.col("total")).alias("pct_failed"))


def batch_errors(df: DataFrame, batch: str = "batch", is_error=None) -> DataFrame:
    """Rows and errors per batch; ``complete`` batches (no error) are the
    ones persisted as partial outputs."""
    err = is_error if is_error is not None else (F.col("level") == "ERROR")
    return (df.groupBy(batch)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(err).alias("n_errors"))
            .withColumn("complete", F.col("n_errors") == 0))


def complete_batches(df: DataFrame, errors: DataFrame, batch: str = "batch") -> DataFrame:
    """Rows of zero-error batches only (left-semi join on the batch key)."""
    return df.join(errors.where("complete").select(batch), batch, "left_semi")


def log_kept_ratio(parsed: DataFrame, keys: Sequence[str] = ("worker", "batch")) -> DataFrame:
    """Per batch prefix the kept lines, the total lines of the log and the
    percentage kept (one decimal)."""
    total = parsed.agg(F.count(F.lit(1))).scalar()
    per = parsed.where(F.col("batch").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("kept"))
    return per.select(*keys, "kept", total.alias("total"),
                      _pct(F.col("kept"), total).alias("pct_kept"))


def table_profile(df: DataFrame) -> DataFrame:
    """Row count plus, per column, its type, NULL and blank counts and an
    example (the smallest value that is not blank), in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, typ in df.dtypes:
        c = F.col(name)
        aggs += [F.max(F.lit(typ)).alias(f"{name}__type"), F.count_if(c.isNull()).alias(f"{name}__nulls")]
        shown = c
        if typ == "string":
            aggs.append(F.count_if(T.strip(c) == "").alias(f"{name}__blanks"))
            shown = F.when(T.strip(c) != "", c)
        aggs.append(F.min(shown).cast("string").alias(f"{name}__example"))
    return df.agg(*aggs).withColumns({f"{n}__type": F.lit(t) for n, t in df.dtypes})


# Line kinds of the text export, in output order within a (book, chapter).
TITLE, BOOK_HEAD, CHAPTER_HEAD, VERSE, CHAPTER_END, BOOK_END = range(6)


def render_text(long: DataFrame, books: DataFrame, version_names: dict[str, str] | None = None,
                version_col: str = "version") -> DataFrame:
    """Readable text per version as one row per output line, never one
    string per chapter or version.

    Layout: ``The Holy Bible - <name>`` and a blank line; per book (dimension
    order) its name, 50 "=", a blank line; per chapter (ascending)
    ``Chapter n``, 20 "-", the lines ``"<verse> <text>"`` ascending by (verse,
    text), a blank line; one more blank line after the book's last chapter.

    Rows carry the sort key (version, book_ord, chapter, kind, verse, seq,
    text); writing them range-partitioned and sorted by that key
    (:func:`parcorpus.sources.sinks.write_text_blocks`) gives the text in part
    order, and a very large chapter is spread over many tasks.
    """
    names = version_names or {}
    dim = books.select(F.col("id").alias("book_id"), F.col("name").alias("_bname"),
                       F.col("ordinal").alias("book_ord"))
    entries = long.select(version_col, "book_id", "chapter", "verse", "text").join(dim, "book_id", "left")
    # a verse of a book that the dimension lacks cannot be placed: the export fails rather than lose headings
    entries = entries.withColumn("_bname", F.coalesce("_bname", F.raise_error(F.concat(
        F.lit("no such book: "), F.coalesce(F.col("book_id").cast("string"), F.lit("null"))))))
    # one aggregation gives the frames of all levels: chapters, books, versions
    book = [version_col, "book_id", "book_ord", "_bname"]
    frames = entries.withColumn("_ch", F.col("chapter")).groupingSets(
        [[*book, "chapter"], book, [version_col]], *book, "chapter").agg(
        F.grouping_id().alias("_level"), F.max("_ch").alias("_last"))
    m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else None
    vname = F.coalesce(m[F.col(version_col)], F.col(version_col)) if m is not None else F.col(version_col)
    null_i = F.lit(None).cast("int")
    bo, c, last = F.col("book_ord"), F.col("chapter"), F.col("_last")

    def line(kind, seq, value, book_ord, chapter):
        return F.struct(book_ord.cast("int").alias("book_ord"), chapter.cast("int").alias("chapter"), F.lit(kind).alias("kind"),
                        F.lit(seq).alias("seq"), value.alias("value"))

    chapter_lines = F.array(
        line(CHAPTER_HEAD, 0, F.concat(F.lit("Chapter "), c.cast("string")), bo, c),
        line(CHAPTER_HEAD, 1, F.lit("-" * 20), bo, c),
        line(CHAPTER_END, 0, F.lit(""), bo, c))
    book_lines = F.array(
        line(BOOK_HEAD, 0, F.col("_bname"), bo, null_i), line(BOOK_HEAD, 1, F.lit("=" * 50), bo, null_i),
        line(BOOK_HEAD, 2, F.lit(""), bo, null_i), line(BOOK_END, 0, F.lit(""), bo, last))
    title_lines = F.array(line(TITLE, 0, F.concat(F.lit("The Holy Bible - "), vname), null_i, null_i),
                          line(TITLE, 1, F.lit(""), null_i, null_i))
    lines_ = F.when(F.col("_level") == 0, chapter_lines).when(F.col("_level") == 1, book_lines).otherwise(title_lines)
    frame = frames.select(version_col, F.explode(lines_).alias("_l")).select(
        version_col, "_l.book_ord", "_l.chapter", "_l.kind", F.lit(0).alias("verse"), "_l.seq", "_l.value")
    verses = entries.select(
        version_col, F.col("book_ord").cast("int").alias("book_ord"),
        F.col("chapter").cast("int").alias("chapter"), F.lit(VERSE).alias("kind"),
        F.col("verse").cast("int").alias("verse"), F.lit(0).alias("seq"),
        F.concat(F.col("verse").cast("string"), F.lit(" "), F.coalesce("text", F.lit(""))).alias("value"))
    return frame.unionByName(verses)


RENDER_ORDER = ["book_ord", "chapter", "kind", "verse", "seq", "value"]
