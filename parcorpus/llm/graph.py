"""Connected components of an edge table, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcorpus.llm.common import discard, written


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; ``root`` is the component's smallest node.

    Alternates two steps until the edges no longer change: every node links its
    larger neighbours, then its smaller ones and itself, to the smallest node
    it sees. Minima are combined map-side, so a node with very many neighbours
    is one row per task; each round is written and cuts the lineage."""

    def distinct(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("m"))

    e = written(distinct(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), F.col("u") == F.col("_u")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        e, old = written(distinct(large), "edges"), e
        discard(old)
        # every edge now leads from the larger to the smaller node
        low = smallest(e)
        small = e.join(low, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e, old = written(distinct(small.unionByName(low.select(F.col("_u").alias("u"), F.col("m").alias("v")))), "edges"), e
        discard(old)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
