"""Task ranges, batches, translation requests and realignment (T4-T8, J-2).

Batches and requests are numbered with the bucketed global row number over a
reproducible hash order (no single-partition window); a request groups at most
25 sentences, so ``collect_list`` per request is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T
from parcorpus.operators import dedup

# Pipeline sizes (fixed values): sentences per batch, sentences per request.
BATCH_SIZE = 30
REQUEST_MIN, REQUEST_MAX = 10, 25


def chapter_ranges(books: DataFrame, chapters: str = "chapters", max_chapters: int = 20,
                   col_start: str = "start_chapter", col_end: str = "end_chapter") -> DataFrame:
    """T4: split 1..n into k = ceil(n / max) contiguous ranges whose sizes
    differ by at most one (the first n mod k ranges are one longer)."""
    n = F.col(chapters)
    k = F.when(n <= max_chapters, F.lit(1)).otherwise(F.ceil(n / F.lit(max_chapters))).cast("int")
    base = (n / k).cast("int")
    rem = n - base * k
    with_k = books.withColumn("_k", k).withColumn("_base", base).withColumn("_rem", rem)
    i = F.col("_i")
    return (with_k.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
            .withColumn(col_start, i * F.col("_base") + F.least(i, F.col("_rem")) + 1)
            .withColumn(col_end, (i + 1) * F.col("_base") + F.least(i + 1, F.col("_rem")))
            .withColumn("range_index", i)
            .drop("_k", "_base", "_rem", "_i"))


def with_versions(ranges: DataFrame, versions: DataFrame, version_col: str, buckets: int = 16) -> DataFrame:
    """J-2: every version for every book range, which is the result asked for.

    The distinct versions are dealt into ``buckets`` and every range is repeated
    once per bucket, so the product is an equi-join on the bucket: it is spread
    over the buckets and no side is gathered or broadcast by force."""
    dim = versions.select(F.col(version_col).alias("version")).distinct().withColumn(
        "_b", F.pmod(F.xxhash64("version"), F.lit(buckets)).cast("int"))
    dealt = ranges.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return dealt.join(dim, "_b").drop("_b")


def task_table(ranges: DataFrame, versions: DataFrame, version_col: str, key_cols: list[str],
               seed: int = 42) -> DataFrame:
    """T5: versions x book ranges, shuffled reproducibly, numbered from 1."""
    tasks = with_versions(ranges, versions, version_col)
    tasks = tasks.withColumn("_h", dedup.hash_order(["version", *key_cols], seed))
    return dedup.global_row_number(tasks, ["_h", "version", *key_cols], "task_id").drop("_h")


def make_batches(df: DataFrame, order: str | Sequence[str] = "pos", size: int = BATCH_SIZE, seed: int = 42,
                 shuffle: bool = True) -> DataFrame:
    """Fixed-size batches in shuffled (hash) or input order; ``rn`` is the
    1-based position, ``batch_id`` starts at 1, the last batch may be short.
    ``order``: the column or columns that tell the rows apart."""
    order = [order] if isinstance(order, str) else list(order)
    if shuffle:
        df = df.withColumn("_h", dedup.hash_order(order, seed))
        order = ["_h", *order]
    numbered = dedup.global_row_number(df, order, "rn").drop("_h")
    return numbered.withColumn("batch_id", F.ceil(F.col("rn") / F.lit(size)).cast("long"))


def request_size(batch_id: Column, seed: int = 42) -> Column:
    """Sentences per request of a batch: 10..25 picked by a hash of the batch."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), batch_id.cast("string"))), 1, 8),
               16, 10).cast("long")
    return F.lit(REQUEST_MIN) + F.pmod(h, F.lit(REQUEST_MAX - REQUEST_MIN + 1))


def make_requests(batches: DataFrame, sl: str = "sl", ol: str = "ol", size: int = BATCH_SIZE,
                  seed: int = 42) -> DataFrame:
    """T7 + S5: within each batch, chunks of k sentences become one request
    text joined with the separator; the sentences travel with the request."""
    k = request_size(F.col("batch_id"), seed)
    in_batch = F.col("rn") - (F.col("batch_id") - 1) * F.lit(size)
    chunked = batches.withColumn("_k", k).withColumn(
        "chunk_id", F.ceil(in_batch / F.col("_k")).cast("long"))
    req = chunked.groupBy("batch_id", "chunk_id").agg(
        F.array_sort(F.collect_list(F.struct("rn", F.col(sl).alias("sl"), F.col(ol).alias("ol"))))
        .alias("sentences"))
    return req.withColumn("request", T.merge_sentences(F.transform("sentences", lambda x: x["sl"]))) \
              .withColumn("n_sentences", F.size("sentences").cast("long"))


def realign(results: DataFrame, translated: str = "translated") -> DataFrame:
    """Split each translated request back into sentences and re-attach the
    source and original by position. sl/ol are whitespace-collapsed, tl cleaned;
    a request whose part count differs yields one ``[ERROR]`` row per sentence.
    Requests answered with (source, target) pairs (a ``pairs`` column) give one
    row per pair with ``ol`` = the stripped request and ``rn`` counted on from
    the request's first sentence.

    Both kinds become one array per request and one explode, so the column that
    the user function filled is evaluated once."""
    sentences = F.col("sentences")
    parts = T.split_translation(F.col(translated), F.col("n_sentences"))
    kind = "array<struct<rn:bigint,sl:string,tl:string,ol:string>>"
    split = F.transform(sentences, lambda s, i: F.struct(
        s["rn"].cast("bigint").alias("rn"), T.collapse_ws(s["sl"]).alias("sl"),
        F.when(F.col("_parts").isNull(), F.lit(T.MARKER_ERROR)).otherwise(
            T.clean_text(F.get("_parts", i))).alias("tl"),
        T.collapse_ws(s["ol"]).alias("ol"))).cast(kind)
    rows = split
    if "pairs" in results.columns:
        first = F.get(sentences, F.lit(0))["rn"].cast("bigint")
        results = results.withColumn("_whole", T.strip(F.col("request")))
        paired = F.transform("pairs", lambda p, i: F.struct(
            (first + i).alias("rn"), p["sl"].alias("sl"), p["tl"].alias("tl"), F.col("_whole").alias("ol"))).cast(kind)
        rows = F.when(F.col("pairs").isNotNull(), paired).otherwise(split)
    return results.withColumn("_parts", parts).select(
        "batch_id", "chunk_id", F.explode(rows).alias("_r")).select("batch_id", "chunk_id", "_r.*")
