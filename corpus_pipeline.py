"""The corpus pipeline: documents in, clean documents with their tokens out.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; ``run`` writes each result below the shared checkpoint folder and
reads it back for the next one.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcorpus.llm import common, decontam, linededup, ngramjoin, quality
from parcorpus.llm.common import table, written
from parcorpus.llm.queries import token_digests

#: Near copies are texts of which the sets of 5-word shingles have a Jaccard similarity from 0.8.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


#: Folders of tables that stages wrote on the way to their results.
_left: list[str] = []


def tidy(stage):
    """Before a stage begins, the tables that earlier stages wrote on their way go, except those
    that ``docs`` still reads: a stage's result is written and read again before the next stage."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = set(common.folders(docs)) if _left else set()
        for folder in [f for f in _left if f not in read]:
            common.drop_folder(spark, folder)
            _left.remove(folder)
        begun = len(common.made)
        out = stage(spark, docs, sf_dir)
        _left.extend(common.made[begun:])
        return out

    return run


def row_places(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, which tells its rows apart whenever it is read: file and place in
    it, if ``docs`` is a table read from files and no more. Any other is written once with a
    number for each row."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" and docs.inputFiles():
        return docs.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("_row"))
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "near-rows")


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host is rejected, go."""
    return quality.keep_good(docs)


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; so does a document of which no word is left."""
    columns = docs.columns
    done = linededup.dedup_lines(docs)
    kept = done.where((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    return kept.select(*[F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias(c)
                         if c == "n_chars" else F.col(c) for c in columns])


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row stays: that with the smallest id, and of rows
    with one id that with the first place. A null id comes after all others.

    Rows go by their place (:func:`row_places`), not by their ids: copies of one row, rows
    without an id and different texts under one id are told apart. A text without words is
    in no group and stays."""
    begun = len(common.made)
    rows = row_places(docs)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    classes = ngramjoin.similar_documents(
        rows.select(place.alias("place"), "text"), "place", shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)
    later = written(classes.where("component_id.row <> place.row").select(F.col("place.row").alias("_gone")), "near-later")
    # what the join wrote on its way to the rows that go
    for folder in [f for f in common.made[begun:] if f not in common.folders(later) + common.folders(rows)]:
        common.drop_folder(spark, folder)
    return rows.join(later, F.col("_row") == F.col("_gone"), "left_anti").select(*docs.columns)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@tidy
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes decoded from them."""
    return token_digests(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: SQL can state neither the tiling nor the token merges; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
