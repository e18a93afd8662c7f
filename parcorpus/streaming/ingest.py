"""Ingest partial result files as they appear.

Each micro-batch of new partial files is cleaned (C5 filters), de-duplicated
inside the batch and freed of the pairs that are stored. What is stored is known
from an index of key hashes in buckets: a batch reads only the buckets that its own
keys fall into. The new rows and their keys are written to folders named after the
stream and the batch; a commit record makes them count. A batch that is replayed
after its commit is passed over; one that was not committed is written anew, to
the same folders. Rows and keys without a commit record are not read.

    corpus/stream=<id>/batch_id=<n>/      rows (JSON, compressed)
    corpus/_keys/bucket=<b>/epoch=<id>-<n>/   SHA-256 digests of (sl, tl)
    corpus/_commits/<id>-<n>

The rows of a batch are dealt out once, by the digest: it de-duplicates them, and
the stored digests come to them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from parcorpus.functions import text as T
from parcorpus.operators import dedup
from parcorpus.sources import manifest

PARTIAL_SCHEMA = T_.StructType([
    T_.StructField("sl", T_.StringType()), T_.StructField("tl", T_.StringType()),
    T_.StructField("ol", T_.StringType()), T_.StructField("pos", T_.LongType()),
])
CORPUS_SCHEMA = T_.StructType([*PARTIAL_SCHEMA.fields, T_.StructField("batch_id", T_.LongType())])
KEY = ["sl", "tl"]
#: Buckets of the key index; they stay the same for the life of a corpus.
BUCKETS = 64
#: How the corpus' rows are compressed; the usual level takes twice as long for a twentieth less.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "THREE"}
#: Shuffle files go when the write that made them has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)).cast("int"))


def _with_key(df: DataFrame) -> DataFrame:
    """A row's key digest, the same as in keep_first, and bucket."""
    return _with_bucket(df.withColumn("_key", dedup.key_digest(KEY, strip=False)))


def committed(spark: SparkSession, corpus_dir: str) -> list[str]:
    """The epochs that count, sorted."""
    return [n for n in manifest.names(spark, f"{corpus_dir}/_commits") if not n.startswith(".")]


def stored_keys(spark: SparkSession, corpus_dir: str, buckets: Sequence[int]) -> DataFrame:
    """Digests (``_key``) of all committed rows in ``buckets``; no other bucket's files are listed or read."""
    there = set(manifest.names(spark, f"{corpus_dir}/_keys"))
    paths = [f"{corpus_dir}/_keys/bucket={b}" for b in buckets if f"bucket={b}" in there]
    if not paths:
        return spark.createDataFrame([], "_key binary")
    # names that the driver holds: broadcast, or all keys of an epoch would meet in one task
    epochs = F.broadcast(spark.createDataFrame([(e,) for e in committed(spark, corpus_dir)], "epoch string"))
    keys = spark.read.schema("_key binary, epoch string").option("basePath", f"{corpus_dir}/_keys").parquet(*paths)
    # files without digests are of an index of 128-bit hashes, as it once was: no row of theirs would be found
    other = F.raise_error(F.lit(f"{corpus_dir}/_keys holds no digests: remove it and the corpus, and ingest anew"))
    return keys.join(epochs, "epoch", "left_semi").select(F.coalesce("_key", other).alias("_key"))


def process_batch(batch: DataFrame, batch_id: int, corpus_dir: str, stream: str = "batch") -> None:
    """Add the new pairs of ``batch`` to the corpus, once for each (stream, batch_id)."""
    spark = batch.sparkSession
    epoch = f"{stream}-{batch_id}"
    if epoch in committed(spark, corpus_dir):
        return
    cleaned = _clean_filter(batch)
    buckets = [r[0] for r in _with_key(cleaned).select("bucket").distinct().collect()]  # at most BUCKETS
    first = dedup.keep_first(cleaned, KEY, "pos", strip=False, with_key=True)
    new = first.join(stored_keys(spark, corpus_dir, buckets), "_key", "left_anti")
    rows = f"{corpus_dir}/stream={stream}/batch_id={batch_id}"
    new.select(*PARTIAL_SCHEMA.names).write.mode("overwrite").options(**COMPRESSED).json(rows)
    written = _with_key(spark.read.schema(PARTIAL_SCHEMA).json(rows))
    (written.select("_key", "bucket", F.lit(epoch).alias("epoch")).repartition("bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "epoch").parquet(f"{corpus_dir}/_keys"))
    manifest.write_record(spark, f"{corpus_dir}/_commits/{epoch}", {"stream": stream, "batch_id": batch_id})


def compact_keys(spark: SparkSession, corpus_dir: str) -> None:
    """Gather the keys of all committed epochs into one file or few per bucket, under an epoch
    of its own; the smaller ones go. No batch may be running meanwhile."""
    old = committed(spark, corpus_dir)
    buckets = [int(n.partition("=")[2]) for n in manifest.names(spark, f"{corpus_dir}/_keys") if n.startswith("bucket=")]
    epoch = f"compact-{uuid.uuid4().hex}"
    keys = _with_bucket(stored_keys(spark, corpus_dir, buckets))
    (keys.withColumn("epoch", F.lit(epoch)).repartition("bucket")
     .write.mode("append").partitionBy("bucket", "epoch").parquet(f"{corpus_dir}/_keys"))
    manifest.write_record(spark, f"{corpus_dir}/_commits/{epoch}", {"compacts": old})
    for b in buckets:
        for n in manifest.names(spark, f"{corpus_dir}/_keys/bucket={b}"):
            if n.partition("=")[2] in old:
                manifest.remove(spark, f"{corpus_dir}/_keys/bucket={b}/{n}")


def _clean_filter(df: DataFrame) -> DataFrame:
    s = F.coalesce(F.col("sl"), F.lit(""))
    t = F.coalesce(F.col("tl"), F.lit(""))
    return df.where((s != t) & ~s.contains(T.MARKER_ERROR) & ~t.contains(T.MARKER_ERROR))


def start_ingest(spark: SparkSession, source_dir: str, corpus_dir: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 dedup: str = "table", within: str | None = None):
    """Start the stream; returns the StreamingQuery.

    ``dedup="table"``: the corpus' key index is the state. An epoch is named after the
    stream's id, which its checkpoint keeps: a stream with a fresh checkpoint gets
    epochs of its own and finds the pairs it reads again stored. ``dedup="state"``:
    Structured Streaming keeps the seen (sl, tl) keys in its state store (per-key
    look-ups; configure the RocksDB provider for large key sets) and the file sink
    commits exactly once. Without ``within`` it keeps them for ever; with ``within``
    (such as "30 days") only those of files changed in that time before the newest.
    """
    reader = spark.readStream.schema(PARTIAL_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source_dir)
    if dedup == "state":
        cleaned = _clean_filter(stream)
        if within:
            cleaned = cleaned.withColumn("_at", F.col("_metadata.file_modification_time")).withWatermark("_at", within)
            deduped = cleaned.dropDuplicatesWithinWatermark(["sl", "tl"]).drop("_at")
        else:
            deduped = cleaned.dropDuplicates(["sl", "tl"])
        writer = (deduped.writeStream.format("json").option("path", corpus_dir)
                  .option("checkpointLocation", checkpoint).outputMode("append"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
            processingTime="10 seconds")
        return writer.start()
    named, query = threading.Event(), []

    def add(df: DataFrame, batch_id: int) -> None:
        named.wait()  # the id is known once the stream has been started
        df.sparkSession.conf.set(CLEANUP, "true")  # a session of the stream's own
        process_batch(df, batch_id, corpus_dir, query[0].id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    query.append(writer.start())
    named.set()
    return query[0]


def read_corpus(spark: SparkSession, corpus_dir: str, dedup: str = "table") -> DataFrame:
    """The rows of the committed epochs, with their ``batch_id``."""
    if dedup == "state":
        return spark.read.schema(PARTIAL_SCHEMA).json(corpus_dir)
    epochs = [e for e in committed(spark, corpus_dir) if not e.startswith("compact-")]
    if not epochs:
        return spark.createDataFrame([], CORPUS_SCHEMA)
    names = F.broadcast(spark.createDataFrame([(e,) for e in epochs], "_epoch string"))  # as in stored_keys
    rows = spark.read.schema(T_.StructType([*PARTIAL_SCHEMA.fields, T_.StructField("stream", T_.StringType()),
                                            T_.StructField("batch_id", T_.LongType())])).json(corpus_dir)
    return rows.join(names, F.concat_ws("-", "stream", "batch_id") == F.col("_epoch"), "left_semi").select(*CORPUS_SCHEMA.names)
