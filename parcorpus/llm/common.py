"""Helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import sys

import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcorpus.session import materialize

# The white space between words, and the ASCII letters that are lower-cased.
WS_CLASS = "[\\x20\\x09-\\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the file, and ids made while
    writing (``monotonically_increasing_id``) stay as written. The plan runs
    this once only, so Spark may drop its shuffle files when it has ended."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        out = materialize(df, name)
    finally:
        conf.set(key, before)
    made.extend(folders(out))
    return out


#: The folders that :func:`written` has made, in order, since the program began.
made: list[str] = []


def folders(df: DataFrame) -> list[str]:
    """The folders that ``df`` reads files of."""
    return sorted({f.rpartition("/")[0] for f in df.inputFiles()})


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this library made below the shared checkpoint folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for df in tables:
        for folder in folders(df):
            drop_folder(df.sparkSession, folder)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of ``text`` (runs without white space); null or blank: no words."""
    parts = F.split(F.coalesce(text, F.lit("")), WS_CLASS + "+")
    return F.filter(parts, lambda w: w != "")


def fingerprint(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes, used together as a 128-bit fingerprint."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def numbered(df: DataFrame, order: list[str], name: str, number: str = "_rn") -> DataFrame:
    """Number the rows of ``df`` 0, 1, 2, ... along ``order``, and add the count ``_total``.

    A range-partitioned sort spreads one value of the leading columns over many
    partitions as long as the later ones differ. The sorted rows are written
    once, so ranks inside a partition cannot change between reads; the offsets
    are a running count over one row per partition, which bounds the broadcast."""
    low = F.lit((1 << 33) - 1)
    s = written(df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).select(
        *df.columns, F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().bitwiseAND(low).alias("_in")), name)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"))
    return s.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_before") + F.col("_in")).alias(number), "_total")


def ship_by_value(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value, so that
    executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def in_slices(batch, column: str, most: int = 4 << 20):
    """Slices of an Arrow batch with about ``most`` bytes of ``column`` each: whole rows, at least one."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for k, n in enumerate(lengths.tolist()):
        if k > begin and total + n > most:
            yield batch.slice(begin, k - begin)
            begin, total = k, 0
        total += n
    yield batch.slice(begin)


def per_process() -> dict:
    """A dictionary that lives as long as the Python worker, for what tasks share (models, automata)."""
    import types

    name = "_parcorpus_per_process"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


ship_by_value(__name__)
