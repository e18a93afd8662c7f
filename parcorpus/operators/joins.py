"""Joins and set operations of the corpus pipeline (J-1, J-5, J-7, U1-U4, C9, C10).

Joins are plain equi-joins; Spark plans a sort-merge join and AQE replaces it by
a broadcast once the smaller side is measured below the threshold, or splits
skewed partitions. No side is broadcast by force.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcorpus.functions import text as T
from parcorpus.operators import dedup


def minus_existing(pairs: DataFrame, corpus: DataFrame, keys: Sequence[str] = ("sl", "ol"),
                   normalize: bool = False) -> DataFrame:
    """J-1/U3: remove pairs already in the corpus (exact equality by default, a
    missing side equal to a missing side); survivors keep their multiplicity."""
    # the corpus side is reduced to distinct keys first (partial aggregation),
    # so a pair repeated many times in the corpus is one build row
    value = T.collapse_ws if normalize else (lambda c: c)
    right = corpus.select(*[value(F.col(k)).alias(f"_c{i}") for i, k in enumerate(keys)]).distinct()
    same = [value(pairs[k]).eqNullSafe(right[f"_c{i}"]) for i, k in enumerate(keys)]
    return pairs.join(right, same, "left_anti")


def append_corpus(new: DataFrame, old: DataFrame, keys: Sequence[str] = ("sl", "tl"),
                  order: str = "pos", gen_col: str = "gen") -> DataFrame:
    """New rows followed by earlier rows (bag union); on a stripped
    (first two keys) collision the new row wins. Returns the labelled union.

    Generation and position are one decimal, a fixed-width value that a hash
    aggregation can hold: ``order`` is a whole number below 10**36 in size."""
    u = (new.withColumn(gen_col, F.lit(0))
         .unionByName(old.withColumn(gen_col, F.lit(1)), allowMissingColumns=True))
    place = F.when(F.col(gen_col) == 0, F.lit("0")).otherwise(F.lit("1" + "0" * 36)).cast("decimal(38,0)")
    u = u.withColumn("_ord", (place + F.col(order).cast("decimal(37,0)")).cast("decimal(38,0)"))
    labelled = dedup.split_duplicates(u, keys, "_ord")
    return labelled.drop("_ord")


def todo_tasks(tasks: DataFrame, done: DataFrame,
               keys: Sequence[str] = ("version", "book", "start_chapter", "end_chapter")
               ) -> DataFrame:
    """J-5: tasks whose key has no stored output yet."""
    return tasks.join(done.select(*keys).distinct(), list(keys), "left_anti")


def exclude_sentences(df: DataFrame, excluded: DataFrame, col: str,
                      excl_col: str = "text") -> DataFrame:
    """Drop rows whose text is exactly one of the excluded sentences."""
    return df.join(excluded.select(F.col(excl_col).alias(col)).distinct(), col, "left_anti")


def drop_null_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Both sides present (blank allowed)."""
    return df.dropna(subset=[a, b])


def zip_pairs(df: DataFrame, a: str, b: str, col: str = "pair") -> DataFrame:
    """J-7: positional pairing of two array columns of one row, cut to the
    shorter one."""
    n = F.least(F.size(a), F.size(b))
    return df.withColumn(col, F.slice(F.arrays_zip(F.col(a), F.col(b)), 1, n))


def lead_pair(df: DataFrame, group: str, index: str, value: str,
              col: str = "next_value") -> DataFrame:
    """J-7 across rows: each row paired with the row at index + 1 of the same
    group, by an equi-join on the composite (group, index) key."""
    nxt = df.select(F.col(group), (F.col(index) - 1).alias(index), F.col(value).alias(col))
    return df.join(nxt, [group, index], "inner")


def union_languages(wide: DataFrame, src: str, targets: dict[str, str]) -> DataFrame:
    """U1 + C4 + P1 + P2 in one scan: wide table -> (en, target, language) for
    every valid (source, target column) pair; ``targets`` maps column -> code."""
    stacked = wide.select(F.col(src).alias("en"), F.explode(F.array(*[
        F.struct(F.col(c).alias("target"), F.lit(code).alias("language"))
        for c, code in targets.items()])).alias("_t")).select("en", "_t.*")
    return stacked.where(T.is_valid_text("en") & T.is_valid_text("target"))


def even_then_odd(df: DataFrame, cls: str = "cls", index: str = "idx", ties: Sequence[str] = ()) -> DataFrame:
    """U4: all ``even`` rows, then all ``odd`` rows, each in index order, and rows
    of one index (of different tables) by ``ties``."""
    return df.orderBy((F.col(cls) == "odd"), F.col(index), *ties)


def read_many(tables: Sequence[DataFrame], src: str, tgt: str, order: str = "pos") -> DataFrame:
    """A5: concatenate several pair tables; blank rows dropped and duplicates
    removed per table (not across tables), in a single aggregation."""
    tagged = [t.select(F.lit(i).alias("dataset"), F.col(src), F.col(tgt), F.col(order))
              for i, t in enumerate(tables)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t)
    u = u.where(T.is_valid_row(src, tgt))
    return dedup.keep_first(u, ["dataset", src, tgt], order, strip=False)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small literal dimension (size fixed by the caller); the planner knows its size."""
    return spark.createDataFrame(rows, schema)
