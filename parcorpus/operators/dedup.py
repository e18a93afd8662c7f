"""De-duplication, ordering-dependent labels and global numbering.

"First occurrence" is defined by an explicit order column (``pos``). Labels are
computed as aggregate-then-join: the per-key minimum position is a partial
aggregation (a hot key is combined map-side), and the join back is a plain
equi-join that AQE may broadcast or split when a key is skewed. No window is
partitioned by a text key, so no single task ever has to sort a hot group.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T


def _key_cols(keys: Sequence[str], strip: bool) -> dict[str, Column]:
    out = {}
    for i, k in enumerate(keys):
        c = F.coalesce(F.col(k), F.lit(""))
        out[f"_k{i}"] = T.strip(c) if strip else c
    return out


def key_digest(keys: Sequence[str], strip: bool) -> Column:
    """SHA-256 of a key's values with their lengths: 32 bytes that stand for the key wherever
    rows are dealt, sorted and joined by it, so that no text is carried for that."""
    values = [c.cast("string") for c in _key_cols(keys, strip).values()]
    return F.unhex(F.sha2(F.concat(*[x for v in values for x in (F.octet_length(v).cast("string"), F.lit(":"), v)]), 256))


def label_first(df: DataFrame, keys: Sequence[str], order: str = "pos", strip: bool = True,
                col: str = "is_duplicate") -> DataFrame:
    """Label rows: the first row (by ``order``) of each key is unique, every
    later row a duplicate. Missing key values count as ``""``."""
    keyed = df.withColumn("_key", key_digest(keys, strip))
    first = keyed.groupBy("_key").agg(F.min(order).alias("_first"))
    return (keyed.join(first, "_key", "inner")
            .withColumn(col, F.col(order) > F.col("_first"))
            .drop("_key", "_first"))


def split_duplicates(df: DataFrame, keys: Sequence[str], order: str = "pos",
                     strip: bool = True, col: str = "is_duplicate") -> DataFrame:
    """the key is the first two names of ``keys`` (a third is ignored, as in
    the pipeline), stripped; returns the table with a duplicate label (use
    :func:`unique_part`/:func:`duplicate_part` or ``write.partitionBy``)."""
    return label_first(df, list(keys)[:2], order, strip, col)


def unique_part(labelled: DataFrame, col: str = "is_duplicate") -> DataFrame:
    return labelled.where(~F.col(col)).drop(col)


def duplicate_part(labelled: DataFrame, col: str = "is_duplicate") -> DataFrame:
    return labelled.where(F.col(col)).drop(col)


def keep_first(df: DataFrame, keys: Sequence[str], order: str = "pos",
               strip: bool = False, with_key: bool = False) -> DataFrame:
    """F4/F5 when only the unique half is wanted: one aggregation that keeps the
    whole first row per key (``min_by``, combined map-side). Its buffer holds a
    row of any width, so Spark plans it as a sort aggregation. ``with_key`` leaves
    the key's digest in the rows as ``_key``: they are dealt and sorted by it, and a
    join on it need not deal them out again."""
    cols = df.columns
    return (df.withColumn("_key", key_digest(keys, strip)).groupBy("_key")
            .agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r"))
            .select("_r.*", *["_key"] * with_key))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                    order: str | None = None) -> DataFrame:
    """keep one row per subset (all columns by default); with ``order`` the
    first one is kept, otherwise any one."""
    if order is None:
        return df.dropDuplicates(list(subset) if subset else None)
    return keep_first(df, list(subset) if subset else [c for c in df.columns if c != order], order)


def cross_seen(df: DataFrame, src: str, tgt: str, order: str = "pos",
               col: str = "is_duplicate") -> DataFrame:
    """a row is a duplicate iff its stripped source *and* its stripped target
    each occurred in some earlier row (possibly different rows). Equal to the
    sequential rule because a duplicate never adds an unseen value."""
    s = T.strip(F.coalesce(F.col(src), F.lit("")))
    t = T.strip(F.coalesce(F.col(tgt), F.lit("")))
    keyed = df.withColumns({"_s": s, "_t": t})
    fs = keyed.groupBy("_s").agg(F.min(order).alias("_fs"))
    ft = keyed.groupBy("_t").agg(F.min(order).alias("_ft"))
    return (keyed.join(fs, "_s").join(ft, "_t")
            .withColumn(col, (F.col(order) > F.col("_fs")) & (F.col(order) > F.col("_ft")))
            .drop("_s", "_t", "_fs", "_ft"))


def mark_all_duplicates(df: DataFrame, keys: Sequence[str], col: str = "is_duplicate") -> DataFrame:
    """every member of a key group of size > 1, the first included; exact
    values, NULLs equal to each other."""
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    cnt = cnt.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_n")
    cond = [df[k].eqNullSafe(cnt[f"_c_{k}"]) for k in keys]
    return (df.join(cnt, cond, "inner")
            .withColumn(col, F.col("_n") > 1)
            .drop("_n", *[f"_c_{k}" for k in keys]))


def clean_corpus(df: DataFrame, sl: str = "sl", tl: str = "tl", order: str = "pos") -> DataFrame:
    """Drop rows whose source equals the translation (missing = ""), rows
    with "[ERROR]" anywhere in either, then keep the first of each exact
    (sl, tl) pair."""
    s = F.coalesce(F.col(sl), F.lit(""))
    t = F.coalesce(F.col(tl), F.lit(""))
    kept = df.where((s != t) & ~s.contains(T.MARKER_ERROR) & ~t.contains(T.MARKER_ERROR))
    return keep_first(kept, [sl, tl], order, strip=False)


def drop_untranslated(df: DataFrame, sl: str = "sl", tl: str = "tl") -> DataFrame:
    """Keep rows whose translation differs from the source."""
    return df.where(~F.col(tl).eqNullSafe(F.col(sl)))


def dedup_stats(labelled: DataFrame, col: str = "is_duplicate") -> DataFrame:
    """Total / unique / duplicates of a labelled table."""
    return labelled.agg(F.count(F.lit(1)).alias("total"),
                        F.count_if(~F.col(col)).alias("unique"),
                        F.count_if(F.col(col)).alias("duplicates"))


def newest_per_key(df: DataFrame, keys: Sequence[str], mtime: str) -> DataFrame:
    """newest row per key by modification time; of rows with the same time
    the one whose columns sort last."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(F.col(mtime), row)).alias("_r")).select("_r.*")


def run_rank(runs: DataFrame, run_col: str = "run_id", col: str = "run_rank") -> DataFrame:
    """rank of each run id from the newest (1 = last, 2 = second-last): its
    place among the distinct run ids, sorted."""
    distinct = runs.select(run_col).distinct().orderBy(F.col(run_col).desc())
    return with_place(distinct, col).withColumn(col, F.col(col).cast("int"))


def hash_order(cols: Sequence[str], seed: int = 42) -> Column:
    """Reproducible pseudo-random order key: first 60 bits of md5(seed|key)."""
    key = F.concat_ws("\u0001", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                   for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def with_place(df: DataFrame, col: str = "place") -> DataFrame:
    """The rows of ``df`` with their 1-based place in the order in which they come.

    Rows are numbered inside each partition by ``monotonically_increasing_id``
    (partition index in the upper bits, row index in the lower 33). That numbering is
    written once under the shared checkpoint folder, so the count branch and the row
    branch see the same partitions and a retried task cannot renumber rows. A
    partition's offset is the running count of those before it; the driver adds up
    one number per partition and broadcasts as many, which bounds both."""
    from parcorpus.session import materialize

    with_id = materialize(
        df.withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", 33))
        .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))), "places")
    counts = sorted(with_id.groupBy("_pid").agg(F.count(F.lit(1))).collect())
    before = [0, *itertools.accumulate(n for _, n in counts)]
    offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_pid long, _off long")
    return (with_id.join(F.broadcast(offsets), "_pid")
            .withColumn(col, F.col("_local") + F.col("_off") + 1)
            .drop("_mid", "_pid", "_local", "_off"))


def _key_places(keys: DataFrame) -> DataFrame:
    """Per distinct row of ``keys``: ``_first``, the place of its first copy in the sorted
    table, and ``_n``, its copies. Only the keys are sorted and written."""
    return with_place(keys.orderBy(*keys.columns), "_at").groupBy(*keys.columns).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))


def _join_places(df: DataFrame, places: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = places.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
                          *[c for c in places.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)]
    return df.join(named, same, "inner").drop(*[f"_o{i}" for i in range(len(keys))])


def global_row_number(df: DataFrame, order: str | Sequence[str], col: str = "rn",
                      keep: Column | None = None) -> DataFrame:
    """F8: 1-based position over the whole table by ``order``, without moving
    all rows to one partition and without copying them.

    Only the order columns are sorted (range-partitioned: Spark samples them to
    balance the ranges), numbered and written; the rows get their number by a join
    on these columns, NULLs first and equal to each other. ``keep`` returns only the
    rows for which it holds, numbered among all.

    ``order`` names one column or several that should tell the rows apart and come
    out the same whenever ``df`` is computed. Rows that agree in all of them are
    numbered among themselves by a hash of the whole row, again by keys alone;
    rows that are equal as a whole are counted, map-side first, and spread over
    their numbers."""
    order = [order] if isinstance(order, str) else list(order)
    places = _key_places(df.select(*order))
    kept = df if keep is None else df.where(keep)
    if places.where("_n > 1").isEmpty():
        return _join_places(kept, places, order).withColumn(col, F.col("_first")).drop("_first", "_n")
    tied = _join_places(df, places.where("_n > 1").drop("_n").withColumnRenamed("_first", "_group"), order).withColumns({
        "_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit(1), *df.columns)})
    among = ["_group", "_h1", "_h2"]
    within = _key_places(tied.select(*among))
    base = within.groupBy(F.col("_group").alias("_g")).agg(F.min("_first").alias("_base"))
    within = within.join(base, F.col("_group") == F.col("_g")).select(
        *among, (F.col("_group") + F.col("_first") - F.col("_base")).alias("_rn"))
    copies = _join_places(tied if keep is None else tied.where(keep), within, among).groupBy(*df.columns, "_rn").agg(
        F.count(F.lit(1)).alias("_copies"))
    several = copies.withColumn(col, F.explode(F.sequence(F.col("_rn"), F.col("_rn") + F.col("_copies") - 1)))
    alone = _join_places(kept, places.where("_n = 1"), order).withColumn(col, F.col("_first"))
    return alone.select(*df.columns, col).unionByName(several.select(*df.columns, col))


def failure_report(df: DataFrame, order: str = "pos", sl: str = "sl", tl: str = "tl",
                   ol: str = "ol") -> DataFrame:
    """failed rows numbered by their position among all rows."""
    return global_row_number(df, order, "idx", keep=T.is_failed(tl)).select(
        "idx", F.format_string("#%04d", F.col("idx")).alias("label"),
        F.col(sl).alias("sl"), F.coalesce(F.col(ol), F.lit("N/A")).alias("ol"),
        F.col(tl).alias("tl"))
