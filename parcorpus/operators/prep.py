"""Training-set preparation.

Splits are decided per row from a hash of the row's content, so they need no
shuffle and stay stable when rows are added; the exact-size split numbers rows
with the bucketed global row number (no single-partition window). The
vocabulary is a bounded top-k; encoding explodes at most ``max_len`` tokens per
row, looks them up by an equi-join (AQE broadcasts the vocabulary where it has
measured it small) and gathers them again with the row itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T
from parcorpus.operators import dedup

# Reserved token ids (fixed values): padding, end of sequence, unknown.
PAD_ID, EOS_ID, UNK_ID = 0, 1, 2
FIRST_ID = 3


def split_key(cols: Sequence[str], seed: int = 42) -> Column:
    """Hash key of a row: md5 of ``seed | col1 | col2 ...`` (NULL -> "")."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)),
                             *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def hash_fraction(cols: Sequence[str], seed: int = 42) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of the row hash."""
    return F.conv(F.substring(split_key(cols, seed), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def hash_split(df: DataFrame, cols: Sequence[str], test_size: float = 0.2, seed: int = 42,
               col: str = "split") -> DataFrame:
    """L3 (default): ``test`` when the row's hash fraction is below
    ``test_size``; no shuffle, membership independent of other rows."""
    return df.withColumn(col, F.when(hash_fraction(cols, seed) < F.lit(test_size), F.lit("test"))
                         .otherwise(F.lit("train")))


def exact_split(df: DataFrame, cols: Sequence[str], test_size: float = 0.2, seed: int = 42,
                col: str = "split", rule: str = "ceil_test") -> DataFrame:
    """L3/L4 exact sizes: rows ordered by their hash; the first ``ceil(0.2 n)``
    are test (``ceil_test``) or the first ``int(0.8 n)`` are train
    (``floor_train``, the CSV path). Rows of one hash are ordered by the columns
    that it does not cover."""
    keyed = df.withColumn("_h", dedup.hash_order(cols, seed))
    numbered = dedup.global_row_number(keyed, ["_h", *[c for c in df.columns if c not in cols]], "_rn")
    n = df.agg(F.count(F.lit(1))).scalar()
    if rule == "ceil_test":
        n_test = F.ceil(n * F.lit(test_size)).cast("long")
        lab = F.when(F.col("_rn") <= n_test, F.lit("test")).otherwise(F.lit("train"))
    else:
        n_train = F.floor(n * F.lit(1.0 - test_size)).cast("long")
        lab = F.when(F.col("_rn") <= n_train, F.lit("train")).otherwise(F.lit("test"))
    return numbered.withColumn(col, lab).drop("_h", "_rn")


def shuffle_order(df: DataFrame, cols: Sequence[str], seed: int = 42) -> DataFrame:
    """L2: reproducible random order (by row hash), unlike ``rand()`` after a
    repartition."""
    return df.orderBy(dedup.hash_order(cols, seed))


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def tokens(c) -> Column:
    """Whitespace tokens of a text (WS class, empty pieces removed)."""
    return T.split_ws(c if isinstance(c, Column) else F.col(c))


def build_vocab(df: DataFrame, cols: Sequence[str], size: int) -> DataFrame:
    """The ``size - 3`` most frequent tokens ranked by (count desc, token
    asc) get ids from 3; 0/1/2 are pad/eos/unk."""
    toks = df.select(F.explode(F.concat(*[tokens(F.col(c)) for c in cols])).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col("token")).limit(max(0, size - FIRST_ID))
    # the ranked top-k is bounded by ``size``: numbering it in one partition is fine
    from pyspark.sql import Window
    return top.withColumn("id", (F.row_number().over(
        Window.orderBy(F.col("count").desc(), F.col("token"))) + FIRST_ID - 1).cast("int"))


def pad(ids: Column, max_len: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(PAD_ID), F.lit(max_len) - F.size(ids)))


#: Copies of the dictionary in a look-up, so that a part on a third of all rows is spread over as many tasks.
SALTS = 16


def _looked_up(df: DataFrame, parts: Column, dim: DataFrame, key: str, value: str) -> DataFrame:
    """``_row`` (the row) and ``_e`` (its looked-up parts) for every row of ``df``.

    ``parts``: array of (s, p, key). Each row gets an id made here, so rows
    that are equal stay apart. The row rides on one extra part (s = -1), so the
    table is read, exploded and gathered once and never joined with itself. Parts
    look for the copy of the dictionary that their row's id names; the part with
    the row has a place of its own beyond all copies, so rows are dealt evenly
    and find nothing."""
    kind = f"array<struct<s:int,p:int,{key}:{dict(dim.dtypes)[key]}>>"
    head = F.array(F.struct(F.lit(-1).alias("s"), F.lit(-1).alias("p"), F.lit(None).alias(key))).cast(kind)
    rows = df.select(F.struct(*df.columns).alias("_row"), F.concat(head, parts.cast(kind)).alias("_parts")).withColumn(
        "_rid", F.monotonically_increasing_id())  # before the explode, so one per row
    ex = rows.select("_rid", "_row", F.explode("_parts").alias("_x"))
    rides = F.col("_x.s") < 0
    nothing = F.lit("" if dict(dim.dtypes)[key] == "string" else 0).cast(dict(dim.dtypes)[key])
    ex = ex.select("_rid", F.when(rides, F.col("_row")).alias("_row"), "_x.s", "_x.p",
                   F.when(rides, nothing).otherwise(F.col(f"_x.{key}")).alias("_key"),
                   F.when(rides, F.col("_rid") + SALTS).otherwise(F.pmod(F.xxhash64("_rid"), F.lit(SALTS))).alias("_copy"))
    copies = dim.select(F.col(key).alias("_k"), F.col(value),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_c"))
    found = ex.join(copies, (F.col("_key") == F.col("_k")) & (F.col("_copy") == F.col("_c")), "left")
    return found.groupBy("_rid").agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        F.array_sort(F.collect_list(F.when(F.col("s") >= 0, F.struct("s", "p", value)))).alias("_e"))


def encode_fixed(df: DataFrame, vocab: DataFrame, src: str = "prompt", tgt: str = "target",
                 max_len: int = 128) -> DataFrame:
    """``input_ids``/``attention_mask`` from ``src`` and ``labels`` from
    ``tgt``, each exactly ``max_len`` long (truncate, pad with 0; unknown
    tokens -> 2)."""
    def side(c: str, s: int) -> Column:
        return F.transform(F.slice(tokens(c), 1, max_len), lambda t, i: F.struct(
            F.lit(s).alias("s"), i.alias("p"), t.alias("token")))

    # a missing side has no tokens
    sides = F.concat(*[F.coalesce(side(c, s), F.array().cast("array<struct<s:int,p:int,token:string>>"))
                       for s, c in enumerate((src, tgt))])
    rows = _looked_up(df, sides, vocab.select("token", "id"), "token", "id")

    def ids(side: int) -> Column:
        return F.transform(F.filter("_e", lambda x: x["s"] == side), lambda x: F.coalesce(x["id"], F.lit(UNK_ID)))

    return (rows.select("_row.*", ids(0).alias("_ids"), ids(1).alias("_lab"))
            .withColumn("input_ids", pad(F.col("_ids"), max_len))
            .withColumn("attention_mask", F.concat(
                F.array_repeat(F.lit(1), F.size("_ids")),
                F.array_repeat(F.lit(0), F.lit(max_len) - F.size("_ids"))))
            .withColumn("labels", pad(F.col("_lab"), max_len))
            .drop("_ids", "_lab"))


def decode_ids(df: DataFrame, ids: str, vocab: DataFrame, col: str = "decoded") -> DataFrame:
    """Ids -> text joined by spaces, reserved ids (0, 1, 2) skipped."""
    parts = F.transform(F.filter(F.coalesce(F.col(ids), F.array().cast("array<int>")), lambda i: i >= FIRST_ID),
                        lambda x, i: F.struct(F.lit(0).alias("s"), i.alias("p"), x.alias("id")))
    rows = _looked_up(df, parts, vocab.select("id", "token"), "id", "token")
    return rows.select("_row.*", F.array_join(F.transform("_e", lambda x: x["token"]), " ").alias(col))
