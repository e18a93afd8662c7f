"""Dimension tables from caller-supplied rows (books, versions, words).

The reference keeps these as literal lists in code; here the caller passes the
rows, so nothing is hard-coded. The planner knows the size of such a table and
broadcasts it where that is small; none is broadcast by force. The word list is
de-duplicated on use because the source list contains repeats.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

BOOK_SCHEMA = "name string, abbr string, chapters int, id int"
VERSION_SCHEMA = ("text string, suffix string, id int, language string, name string, "
                  "file string, apocrypha boolean")


def book_dim(spark: SparkSession, books: Iterable[Mapping]) -> DataFrame:
    """Books with their dimension order (``ordinal`` = position in the list)."""
    rows = [(b["name"], b.get("abbr"), b.get("chapters"), b["id"]) for b in books]
    order = {r[3]: i for i, r in enumerate(rows)}
    return spark.createDataFrame([(*r, order[r[3]]) for r in rows], BOOK_SCHEMA + ", ordinal int")


def version_dim(spark: SparkSession, versions: Iterable[Mapping]) -> DataFrame:
    rows = [(v["text"], v.get("suffix"), v.get("id"), v.get("language"), v.get("name"),
             v.get("file"), bool(v.get("apocrypha", False))) for v in versions]
    return spark.createDataFrame(rows, VERSION_SCHEMA)


def word_dim(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """Search words, distinct (the source list has repeats)."""
    return spark.createDataFrame([(w,) for w in words], "word string").distinct()
