"""Sinks (B1-B9). Every multi-output write is one job: a label column plus
``partitionBy`` instead of one pass per output."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from parcorpus.functions import text as T
from parcorpus.operators import dedup
from parcorpus.sources import manifest


def write_json(df: DataFrame, path: str, keys: Sequence[str] | None = None,
               save_duplicates: bool = False, order: str = "pos",
               keys_to_remove: Sequence[str] | None = None) -> str | None:
    """B1: JSON lines (UTF-8, not escaped). ``keys_to_remove`` columns are
    dropped first (P3). With ``keys`` the rows are split into unique/duplicates
    (F1, first two keys, stripped); ``save_duplicates`` writes the duplicates
    too, under ``part=duplicates``. Empty input writes nothing."""
    if keys_to_remove:
        df = df.drop(*[k for k in keys_to_remove if k not in (order,)])
    if df.isEmpty():
        return None
    if keys is not None:
        if not keys:
            raise ValueError("write_json: keys must not be empty when given")
        lab = dedup.split_duplicates(df, keys, order)
        lab = lab.withColumn("part", F.when(F.col("is_duplicate"), F.lit("duplicates"))
                             .otherwise(F.lit("unique"))).drop("is_duplicate")
        if not save_duplicates:
            lab = lab.where(F.col("part") == "unique")
        lab.write.mode("overwrite").partitionBy("part").json(path)
    else:
        df.write.mode("overwrite").json(path)
    return path


def prepare_csv(df: DataFrame, columns: Sequence[str], dedup_columns: Sequence[str] | None = (),
                tl: str | None = "tl", order: str | None = None) -> DataFrame:
    """B2 body. De-duplication runs over the rows as given: ``None`` -> all
    their columns, ``[]`` (default) -> none, a list -> the names present (none
    present -> no de-duplication); with ``order`` the first row is kept. Then
    the output columns are selected in order (missing ones NULL), ``status`` is
    derived from the translation before cleaning (so a bare ``[ERROR]`` stays
    visible), and every text cell is cleaned (S1)."""
    out = df
    if dedup_columns is None:
        subset = [c for c in df.columns if c != order]
    else:
        subset = [c for c in dedup_columns if c in df.columns]
    if subset:
        out = dedup.drop_duplicates(out, subset, order)
    for c in columns:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    out = out.select(*columns)
    if tl and tl in columns:
        out = out.withColumn("status", T.parse_status(tl)["status"])
    strings = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string"
               and f.name != "status"]
    return out.withColumns({c: T.clean_text(F.col(c)) for c in strings})


def write_csv(df: DataFrame, path: str, columns: Sequence[str],
              dedup_columns: Sequence[str] | None = (), order: str | None = None) -> str | None:
    """B2: CSV with header after :func:`prepare_csv`; empty input -> None."""
    if df.isEmpty():
        return None
    prepare_csv(df, columns, dedup_columns, order=order).write.mode("overwrite") \
        .option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_quoted_csv(df: DataFrame, path: str) -> str:
    """Every field quoted, quotes doubled."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True) \
        .option("escape", '"').csv(path)
    return path


def write_run(df: DataFrame, root: str, run_ts, fmt: str = "json") -> str:
    """Output of one run under ``root/run_id=YYYYmmdd_HHMMSS`` so runs
    accumulate; re-running the same run overwrites only its own folder."""
    stamped = df.withColumn("run_id", T.run_stamp(F.lit(run_ts).cast("timestamp")))
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").format(fmt).save(root))
    return root


def write_partials(df: DataFrame, root: str, sl: str = "sl", tl: str = "tl",
                   batch: str = "batch_id", only_complete: bool = False, per_folder: int = 1000) -> str:
    """Outputs per batch, untranslated rows removed (C6); with
    ``only_complete`` only batches without a failed row are written (G12).

    A folder ``batch_group=<g>`` holds ``per_folder`` batches following each other;
    the rows carry their batch. A manifest names the folders of every group and the
    columns of the whole. A call writes its rows to folders of its own; of the groups
    that it shares with what is stored, and of no others, it reads the stored rows
    (a value that does not fit its column is an error) and writes those of the other
    batches beside its own. Then the manifest is swapped, so a call that is killed
    leaves what was stored, and of two calls at once the second fails. A batch of
    which no row is left to write keeps what is stored. Read with
    :func:`read_partials`; :func:`drop_replaced` deletes what no manifest names."""
    spark = df.sparkSession
    rows = dedup.drop_untranslated(df, sl, tl)
    if only_complete:
        bad = df.where(T.is_failed(tl)).select(batch).distinct()
        rows = rows.join(bad, batch, "left_anti").select(*df.columns)
    rows = rows.drop(*[f.name for f in rows.schema.fields if f.dataType == NullType()])
    group = F.expr(f"cast(`{batch}` as bigint) div {per_folder}")
    version, state = manifest.latest(spark, root)
    groups = state["groups"] if state else {}
    stored = StructType.fromJson(state["schema"]) if state else StructType()
    schema = StructType([*rows.schema.fields, *[f for f in stored.fields if f.name not in rows.columns]])
    made = f"part-{uuid.uuid4().hex}"
    rows.withColumn("batch_group", group).write.partitionBy("batch_group").json(f"{root}/{made}/new")
    written = [n for n in manifest.names(spark, f"{root}/{made}/new") if n.startswith("batch_group=")]
    if not written:
        manifest.remove(spark, f"{root}/{made}")
        return root
    shared = [n for n in written if n in groups]
    if shared:
        read = spark.read.option("mode", "FAILFAST")
        old = read.schema(schema).json([f"{root}/{p}/{n}" for n in shared for p in groups[n]])
        again = read.schema(schema).json([f"{root}/{made}/new/{n}" for n in shared]).select(F.col(batch).alias("_again")).distinct()
        kept = old.join(again, F.col(batch).eqNullSafe(F.col("_again")), "left_anti")
        kept.withColumn("batch_group", group).write.partitionBy("batch_group").json(f"{root}/{made}/kept")
    kept_groups = set(manifest.names(spark, f"{root}/{made}/kept"))
    new = {n: [f"{made}/new"] + [f"{made}/kept"] * (n in kept_groups) for n in written}
    manifest.swap(spark, root, version, {"groups": groups | new, "schema": schema.jsonValue()})
    return root


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    """What :func:`write_partials` stored below ``root``, with the columns of all its calls."""
    _, state = manifest.latest(spark, root)
    if state is None:
        raise FileNotFoundError(f"{root}: no partial outputs")
    return spark.read.schema(StructType.fromJson(state["schema"])).option("mode", "FAILFAST").json(
        [f"{root}/{p}/{n}" for n, parts in state["groups"].items() for p in parts])


def drop_replaced(spark: SparkSession, root: str) -> None:
    """Delete the folders of partial outputs that the newest manifest does not name. No
    call may be writing, and no earlier result be read, meanwhile."""
    _, state = manifest.latest(spark, root)
    named = {f"{p}/{n}" for n, parts in (state["groups"] if state else {}).items() for p in parts}
    for made in manifest.names(spark, root):
        if made.startswith("part-"):
            for kind in manifest.names(spark, f"{root}/{made}"):
                for n in manifest.names(spark, f"{root}/{made}/{kind}"):
                    if n.startswith("batch_group=") and f"{made}/{kind}/{n}" not in named:
                        manifest.remove(spark, f"{root}/{made}/{kind}/{n}")


def split_outputs(df: DataFrame, label_col: str, root: str, fmt: str = "json") -> str:
    """N-way split written in one job, one folder per label value."""
    df.write.mode("overwrite").partitionBy(label_col).format(fmt).save(root)
    return root


def write_text_blocks(blocks: DataFrame, root: str, order: Sequence[str],
                      version: str = "version", value: str = "value") -> str:
    """B7 writer: one text folder per version; rows are range-partitioned by
    (version, order...) and sorted within partitions, so concatenating a
    version's part files in name order gives the whole text, and a large
    version or chapter is spread over many tasks. NULL sort keys (a version's
    title) come first."""
    keys = [F.col(version).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in order]
    (blocks.repartitionByRange(*keys)
     .sortWithinPartitions(*keys)
     .select(version, value)
     .write.mode("overwrite").partitionBy(version).text(root))
    return root


def verify_written(spark, path: str, expected: int, fmt: str = "json") -> bool:
    """The output exists and holds the expected number of rows."""
    try:
        n = spark.read.format(fmt).load(path).count()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return n == expected and n > 0
