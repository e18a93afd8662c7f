"""Sources (A1-A9): every reader takes an explicit schema or column list, so no
inference pass runs over the data, and column selection reaches the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from parcorpus.functions import text as T
from parcorpus.operators import dedup, joins

CORRUPT = "_corrupt_record"

# Log line layout: "<ts> [LEVEL] Worker w | Batch i/N | message" (fixed format).
LOG_RE = r"^\S+ \S+ \[[A-Z]+\] .*$"
LOG_LEVEL_RE = r"^\S+ \S+ \[([A-Z]+)\]"
LOG_BATCH_RE = r"^Worker \d+ \| Batch \d+/\d+ \| "


def read_corpus_json(spark: SparkSession, paths: str | Sequence[str],
                     schema: T_.StructType) -> DataFrame:
    """A1: files holding a JSON array of flat objects (or one object). A file
    that cannot be decoded becomes one row with ``_corrupt_record`` set."""
    s = schema
    if CORRUPT not in schema.fieldNames():
        s = T_.StructType(list(schema.fields) + [T_.StructField(CORRUPT, T_.StringType())])
    return (spark.read.schema(s).option("multiLine", True)
            .option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
            .json(paths))


def error_count(df: DataFrame) -> DataFrame:
    """Undecodable files/records of an A1 read, next to the decoded rows (the
    aggregation also reads a data column: Spark refuses a query over raw JSON
    that references only the corrupt-record column)."""
    data = [c for c in df.columns if c != CORRUPT]
    ok = F.col(CORRUPT).isNull()
    if data:
        ok = ok & (F.col(data[0]).isNotNull() | F.col(data[0]).isNull())
    return df.agg(F.count_if(~ok).alias("error_count"), F.count_if(ok).alias("rows"))


def read_corpus_csv(spark: SparkSession, path: str | Sequence[str],
                    columns: Sequence[str]) -> DataFrame:
    """A2: CSV with header, every column a string (blanks stay strings)."""
    schema = T_.StructType([T_.StructField(c, T_.StringType()) for c in columns])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("nullValue", "")
            .option("enforceSchema", False).csv(path))


def read_tmx(spark: SparkSession, path: str, src: str, tgt: str) -> DataFrame:
    """A3: translation-memory XML -> (source, target, source_language,
    target_language). Each ``<tu>`` is one row; the segment of each side is
    picked by its ``xml:lang`` attribute."""
    tuv = T_.StructType([T_.StructField("_xml:lang", T_.StringType()),
                         T_.StructField("seg", T_.StringType())])
    schema = T_.StructType([T_.StructField("tuv", T_.ArrayType(tuv))])
    df = spark.read.format("xml").option("rowTag", "tu").schema(schema).load(path)

    def side(lang):
        return F.get(F.filter("tuv", lambda x: x["_xml:lang"] == lang), 0)

    return df.select(side(src)["seg"].alias("source"), side(tgt)["seg"].alias("target"),
                     F.coalesce(side(src)["_xml:lang"], F.lit(src)).alias("source_language"),
                     F.coalesce(side(tgt)["_xml:lang"], F.lit(tgt)).alias("target_language"))


def read_tmx_blocks(spark: SparkSession, path: str) -> DataFrame:
    """A3 raw-block form: one row per ``<tu>`` block of text (plus the header
    and footer pieces), split on the closing tag."""
    df = spark.read.option("lineSep", "</tu>").text(path)
    return df.select(F.monotonically_increasing_id().alias("block_id"),
                     F.col("value").alias("block"))


def read_pairs(spark: SparkSession, path: str, source_col: str, target_col: str,
               order: str | None = None, on_error: str = "raise") -> DataFrame | None:
    """A4: a two-column pair table; rows with a blank side dropped, then exact
    duplicates removed (first kept when ``order`` is given).

    A missing table, missing columns, or no row before or after the filter is
    an error: ``on_error="raise"`` raises it, ``"skip"`` returns None so that
    the caller goes on with the next table."""
    try:
        df = spark.read.parquet(path)
        cols = [source_col, target_col] + ([order] if order else [])
        missing = set(cols) - set(df.columns)
        if missing:
            raise ValueError(f"missing required columns: {sorted(missing)}")
        if df.isEmpty():
            raise ValueError(f"empty table: {path}")
        valid = df.select(*cols).where(T.is_valid_row(source_col, target_col))
        if valid.isEmpty():
            raise ValueError(f"no valid pair in {path}")
    except (ValueError, AnalysisException):
        if on_error == "skip":
            return None
        raise
    return dedup.drop_duplicates(valid, [source_col, target_col], order)


def read_many(spark: SparkSession, paths: Sequence[str], source_col: str,
              target_col: str, order: str = "pos") -> DataFrame:
    """A5: several pair tables, de-duplicated per table in one aggregation."""
    return joins.read_many([spark.read.parquet(p) for p in paths], source_col, target_col, order)


def run_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the run folders directly under ``root``, in order (listed through
    the file system that the path names; there are as many names as runs)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path)
                  if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def read_previous_run(spark: SparkSession, root: str, glob: str = "*",
                      which: str = "second_last", mode: str = "all",
                      schema: T_.StructType | None = None, fmt: str = "json",
                      subfolder: str | None = None, multi_line: bool = False) -> DataFrame:
    """Files of an earlier run. Runs are the folders directly under
    ``root`` (time-stamped names, ``run_id=<stamp>`` also accepted), sorted
    alphabetically; ``second_last`` skips the current run, ``last`` takes it.
    Only that run's folder (or its ``subfolder``) is listed and read: the files
    matching ``glob``, or with ``mode="latest"`` the newest of them.
    ``multi_line`` reads files that hold one JSON array; with a schema that
    names ``_corrupt_record``, :func:`error_count` counts undecodable ones. A
    missing root, no such run or no matching file gives an empty table."""
    empty = spark.createDataFrame([], schema or T_.StructType([]))
    runs = run_folders(spark, root)
    back = 2 if which == "second_last" else 1
    if len(runs) < back:
        return empty
    run = runs[-back]
    reader = spark.read.option("pathGlobFilter", glob).option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.format(fmt).load("/".join([root.rstrip("/"), run, *([subfolder] if subfolder else [])]))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty
    df = (df.withColumn("_file", F.col("_metadata.file_path"))
          .withColumn("_mtime", F.col("_metadata.file_modification_time"))
          .withColumn("run_id", F.lit(run.removeprefix("run_id="))))
    if mode == "latest":
        newest = df.agg(F.max(F.struct("_mtime", "_file")).alias("m")).select(F.col("m._file").alias("_file"))
        df = df.join(newest, "_file", "left_semi")
    return df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Table of already fetched HTML pages."""
    return spark.read.parquet(path)


def parse_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Log text -> (ts, level, worker, batch, total, message).

    The line layout is anchored, so each part is cut from the line by its own
    delimiters; the whole-line pattern runs once, to tell log lines from others."""
    x = F.col(col)
    at = F.instr(x, "] ")
    rest = x.substr(at + 2, F.length(x))
    head = F.regexp_extract(rest, LOG_BATCH_RE, 0)
    numbers = F.split(F.regexp_replace(head, "[^0-9]+", " "), " ")
    whole = lines.withColumn("_ok", x.rlike(LOG_RE)).withColumn("_head", F.when(F.col("_ok"), head))
    num = lambda k: F.when(F.col("_head") != "", F.get(numbers, F.lit(k)).try_cast("int"))
    part = lambda c: F.when(F.col("_ok"), c).otherwise(F.lit(""))
    return whole.select(
        *lines.columns,
        part(F.substring_index(x, " [", 1)).alias("ts"),
        part(F.regexp_extract(x, LOG_LEVEL_RE, 1)).alias("level"),
        num(1).alias("worker"), num(2).alias("batch"), num(3).alias("total"),
        part(rest.substr(F.length("_head") + 1, F.length(rest))).alias("message"))


def read_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read log files as text and parse every line."""
    return parse_log(spark.read.text(path))


def log_prefix(worker, batch, total) -> Column:
    """Batch prefix written in front of every log message of a batch (numbers or columns)."""
    part = lambda x: x.cast("string") if isinstance(x, Column) else F.lit(str(x))
    return F.concat(F.lit("Worker "), part(worker), F.lit(" | Batch "), part(batch), F.lit("/"), part(total), F.lit(" |"))


def filter_log(lines: DataFrame, worker, batch, total, col: str = "value") -> DataFrame:
    """Lines of one batch, found by the full prefix (a cut prefix such as
    ``Batch 1`` would also match batch 10..19). With columns, the lines that
    carry the prefix of the batch in their own row."""
    return lines.where(F.col(col).contains(log_prefix(worker, batch, total)))


def split_log_by_batch(parsed: DataFrame, root: str, buckets: int = 64) -> str:
    """C12 for every batch at once, in one job: one folder per worker and bucket
    of batches (a folder per batch would be as many folders as batches); a file
    holds its batches' lines with their numbers, in order."""
    rows = parsed.where(F.col("batch").isNotNull()).select(
        "worker", "batch", "value", F.pmod(F.col("batch"), F.lit(buckets)).alias("bucket"))
    (rows.repartition("worker", "bucket").sortWithinPartitions("worker", "bucket", "batch")
     .write.mode("overwrite").partitionBy("worker", "bucket").json(root))
    return root


def read_log_batch(spark: SparkSession, root: str, worker: int, batch: int, buckets: int = 64) -> DataFrame:
    """The lines of one batch from :func:`split_log_by_batch`: only its folder is read."""
    return spark.read.schema("worker int, batch int, value string, bucket int").json(root).where(
        (F.col("worker") == worker) & (F.col("bucket") == batch % buckets) & (F.col("batch") == batch)).select("value")
