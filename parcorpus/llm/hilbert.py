"""Operator 9: sharding along a Hilbert curve.

Each row's metadata dimensions are cut into equi-depth cells, the cells are the
axes of a Hilbert curve, and the rows are sorted by their place on it. Runs of
the sorted rows are the shards, so each shard covers a compact box of the
dimensions and ``prune`` can skip shards by their minima and maxima.

Law of the cut: ``rows``; the counts of any two shards differ by at most one.

Defined results: a null text has no bytes; a null dimension takes cell 0.
Ties are cut by (id, checksum, size), and rows equal in all of these are alike,
so their order does not matter. An empty table gives an empty result. Strings
are cut by their whole values, however long. Only the named columns are read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcorpus.llm.common import numbered, written

BITS = 5


def string_cuts(df: DataFrame, dim: str, bits: int = BITS) -> list[str]:
    """The smallest value of each equi-depth cell of a string column, but for the first cell.

    The distinct values are ranged in order with their counts; a value's cell is where the count
    of the rows before it falls. Whole strings are compared, so a common beginning does no harm."""
    values = written(df.where(F.col(dim).isNotNull()).groupBy(F.col(dim).cast("string").alias("v")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("v").select("v", "n", F.spark_partition_id().alias("_pid")), "hilbert-values")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    sums = values.groupBy("_pid").agg(F.sum("n").alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(earlier(Window.orderBy("_pid"))), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"))
    inside = F.coalesce(F.sum("n").over(earlier(Window.partitionBy("_pid").orderBy("v"))), F.lit(0))
    cells = values.withColumn("_in", inside).join(F.broadcast(sums), "_pid").groupBy(
        F.expr(f"((_before + _in) * {1 << bits}) div _total").alias("cell")).agg(F.min("v").alias("v"))
    return sorted((r["v"] for r in cells.where("cell > 0").collect()), key=lambda v: v.encode())


def with_cells(df: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """Add ``_cell_<k>`` per dimension: its equi-depth cell, 0 .. 2**bits - 1.

    The cuts are 2**bits - 1 values at most per dimension, found over all rows: approximate
    quantiles of a number, counted ranks of a string. The driver gets these few values only."""
    kinds = {f.name: f.dataType for f in df.schema}
    numbers = [k for k, d in enumerate(dims) if isinstance(kinds[d], T.NumericType)]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(F.col(dims[k]).cast("double"), F.lit(shares), F.lit(1000)).alias(f"_{k}")
                     for k in numbers]).first() if numbers else {}

    def cell(k: int) -> Column:
        if k in numbers:
            steps = [F.col(dims[k]).cast("double") > c for c in sorted(set(found[f"_{k}"] or []))]
        else:
            steps = [F.col(dims[k]).cast("string") >= c for c in string_cuts(df, dims[k], bits)]
        return sum([s.cast("int") for s in steps], F.lit(0))

    return df.select("*", *[F.coalesce(cell(k), F.lit(0)).alias(f"_cell_{k}") for k in range(len(dims))])


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve through the cube of 2**bits cells a side."""
    n = len(cells)

    @F.pandas_udf("long")
    def place(axes: pd.DataFrame) -> pd.Series:
        import numpy as np

        x = [axes.iloc[:, k].to_numpy(dtype=np.int64, copy=True) for k in range(n)]
        # undo the rotations and reflections of each level, from the coarsest cell to the finest
        for level in range(bits - 1, 0, -1):
            low = (1 << level) - 1
            for k in range(n):
                up = (x[k] >> level) & 1 == 1
                swap = np.where(up, 0, (x[0] ^ x[k]) & low)
                x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
                if k:
                    x[k] ^= swap
        # Gray decode over the axes
        for k in range(1, n):
            x[k] ^= x[k - 1]
        fix = np.zeros_like(x[0])
        for level in range(bits - 1, 0, -1):
            fix = np.where((x[-1] >> level) & 1 == 1, fix ^ ((1 << level) - 1), fix)
        out = np.zeros_like(x[0])
        for level in range(bits - 1, -1, -1):
            for k in range(n):
                out = (out << 1) | (((x[k] ^ fix) >> level) & 1)
        return pd.Series(out)

    return place(F.struct(*[c.alias(f"a{k}") for k, c in enumerate(cells)]))


def hilbert_shards(df: DataFrame, dims: list[str], ties: list[str], n_shards: int) -> DataFrame:
    """``df`` with ``hilbert`` (place on the curve), ``shard`` and ``slot``.

    ``df`` should hold metadata only: its rows are written and sorted."""
    cells = with_cells(written(df, "hilbert-meta"), dims)
    placed = cells.select(*df.columns, hilbert_index(
        [F.col(f"_cell_{k}") for k in range(len(dims))]).alias("hilbert"))
    rows = numbered(written(placed, "hilbert-placed"), ["hilbert", *ties], "hilbert-sorted")
    shard = F.expr(f"(_rn * {n_shards}) div _total")
    return rows.withColumn("_shard", shard).select(
        *df.columns, "hilbert", F.col("_shard").cast("int").alias("shard"),
        (F.col("_rn") - F.expr(f"(_shard * _total + {n_shards - 1}) div {n_shards}")).alias("slot"))


def manifest(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Rows, and minimum and maximum of each dimension, per shard."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])


def prune(index: DataFrame, **wanted) -> DataFrame:
    """Shards of a manifest that can hold rows with the ``wanted`` values."""
    for d, v in wanted.items():
        index = index.where(F.lit(v).between(F.col(f"min_{d}"), F.col(f"max_{d}")))
    return index.select("shard")
