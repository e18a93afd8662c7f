"""Corpus BLEU (G16) as native Spark aggregations.

Public definition (Papineni et al. 2002, as standardised by Post 2018):
13a tokenisation, n = 1..4, clipped n-gram matches and totals summed over the
corpus, brevity penalty, exponential smoothing of orders without a match, score
0 when nothing matches or an order has no n-grams.

Plan: everything about a row is computed in the row. The hypothesis and the
reference are tokenised with regex expressions; a side's n-grams of one order
are an array of 64-bit hashes, built from the order before. The clipped matches
of two such arrays are the size of their multiset intersection: that of the plain
intersection, and one fold over both sides' repeated hashes, sorted together. A row leaves nine numbers, which are summed per
group with a partial sum in every task, and the formula is a column expression
over one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T

MAX_ORDER = 4

# 13a tokenisation rules (fixed values), applied in this order; Spark
# replacement groups are written $1. The second is ([^0-9])([\.,]) -> "$1 $2 ", stated from
# the point or comma: a match begins there, not at every character that is no digit. Of a
# run of them the first is taken with the character before it, if that is no digit (a text
# begins with a space), the next ones in twos. The definition's first class also has the
# space, which it surrounds by spaces: tokens are split at runs of them, so it is
# left out here.
TOK13A_RULES = [
    (r"([\{-\~\[-\`!-\&\(-\+\:-\@\/])", " $1 "),
    (r"(?=[\.,])(?:(?<![0-9\.,])([\.,])|([\.,])([\.,]))", "$2 $1$3 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]


def tokenize_13a(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    s = F.replace(x, F.lit("<skipped>"), F.lit(""))
    s = F.replace(s, F.lit("-\n"), F.lit(""))
    s = F.replace(s, F.lit("\n"), F.lit(" "))
    unesc = s
    for a, b in [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]:
        unesc = F.replace(unesc, F.lit(a), F.lit(b))
    s = F.when(s.contains("&"), unesc).otherwise(s)
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in TOK13A_RULES:
        s = F.regexp_replace(s, pat, rep)
    return T.split_ws(s)


def _repeats(a: Column) -> Column:
    """The values of an array of longs without one of each, sorted."""
    s = F.sort_array(a)
    return F.array_compact(F.zip_with(s, F.slice(s, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: F.when(x == y, x)))


def clipped_matches(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays of longs, in linear time after a sort;
    null if one of them is.

    It is that of the plain intersection and that of the multiset intersection of what is left
    of both without one of each value. That is nothing where one side has no value twice, and
    little of most other rows: only that goes through a fold. In the fold, ``b``'s values have the lowest bit set and ``a``'s not, so of one value
    those of ``a`` come first; each of ``b`` takes one of them, while any is left."""
    own = F.transform(_repeats(a), lambda x: x.bitwiseAND(F.lit(-2)))
    other = F.transform(_repeats(b), lambda x: x.bitwiseOR(F.lit(1).cast("long")))
    zero = F.lit(0).cast("long")

    def step(acc: Column, x: Column) -> Column:
        value, first = x.bitwiseAND(F.lit(-2)), x.bitwiseAND(F.lit(1).cast("long")) == 0
        left = F.when(acc["value"] == value, acc["left"]).otherwise(zero)
        return F.struct(value.alias("value"), F.when(first, left + 1).otherwise(F.greatest(left - 1, zero)).alias("left"),
                        F.when(first | (left == 0), acc["n"]).otherwise(acc["n"] + 1).alias("n"))

    fold = F.aggregate(F.sort_array(F.concat(own, other)),
                       F.struct(zero.alias("value"), zero.alias("left"), zero.alias("n")), step, lambda acc: acc["n"])
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(a.isNotNull() & b.isNotNull(), F.size(F.array_intersect(a, b)).cast("long") + F.when(once, zero).otherwise(fold))


def bleu_stats(df: DataFrame, hyp: str, ref: str, by: list[str] | None = None) -> DataFrame:
    """Sufficient statistics per group: sys_len, ref_len, correct_n, total_n.

    One scan; no n-gram and no token leaves its row. A row with a missing side
    contributes nothing, one without tokens its other side's length."""
    user_by = list(by or [])
    if not user_by:
        df = df.withColumn("_all", F.lit(0))
    by = user_by or ["_all"]
    rows = df.where(F.col(hyp).isNotNull() & F.col(ref).isNotNull()).select(
        *by, tokenize_13a(hyp).alias("_h"), tokenize_13a(ref).alias("_r"))
    rows = rows.select(*by, F.size("_h").alias("_lh"), F.size("_r").alias("_lr"),
                       *[F.transform(c, lambda t: F.xxhash64(t)).alias(f"{c}1") for c in ("_h", "_r")])
    # each order is a projection of its own over the arrays of the one before; a row
    # without a match of one order has none of the next, and its arrays end there
    for n in range(1, MAX_ORDER + 1):
        rows = rows.select("*", F.coalesce(clipped_matches(F.col(f"_h{n}"), F.col(f"_r{n}")), F.lit(0).cast("long")).alias(f"_c{n}"))
        if n < MAX_ORDER:
            rows = rows.select("*", *[F.when(F.col(f"_c{n}") > 0, F.zip_with(
                F.slice(f"{c}{n}", 1, F.greatest(F.size(f"{c}{n}") - 1, F.lit(0))),
                F.slice(f"{c}1", n + 1, F.greatest(F.size(f"{c}1") - n, F.lit(0))),
                lambda a, b: F.xxhash64(a, b))).alias(f"{c}{n + 1}") for c in ("_h", "_r")])
    out = rows.groupBy(*by).agg(
        F.sum("_lh").alias("sys_len"), F.sum("_lr").alias("ref_len"),
        *[F.sum(F.greatest(F.col("_lh") - F.lit(n - 1), F.lit(0))).alias(f"total_{n}")
          for n in range(1, MAX_ORDER + 1)],
        *[F.sum(f"_c{n}").alias(f"correct_{n}") for n in range(1, MAX_ORDER + 1)])
    return out if user_by else out.drop("_all")


def bleu_score(stats: DataFrame) -> Column:
    """Score column from :func:`bleu_stats` columns."""
    c = [F.col(f"correct_{n}").cast("double") for n in range(1, MAX_ORDER + 1)]
    t = [F.col(f"total_{n}").cast("double") for n in range(1, MAX_ORDER + 1)]
    logs = []
    zeros = F.lit(0)
    for n in range(MAX_ORDER):
        zeros = zeros + F.when(c[n] == 0, F.lit(1)).otherwise(F.lit(0))
        p = (F.when(t[n] == 0, F.lit(0.0))
             .when(c[n] == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * t[n]))
             .otherwise(F.lit(100.0) * c[n] / t[n]))
        logs.append(F.when(p > 0, F.log(p)).otherwise(F.lit(-9999999999.0)))
    mean_log = sum(logs[1:], logs[0]) / F.lit(float(MAX_ORDER))
    sys_len = F.col("sys_len").cast("double")
    ref_len = F.col("ref_len").cast("double")
    bp = (F.when(sys_len < ref_len,
                 F.when(sys_len > 0, F.exp(F.lit(1.0) - ref_len / sys_len)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0)))
    any_match = sum(c[1:], c[0]) > 0
    return F.when(any_match, bp * F.exp(mean_log)).otherwise(F.lit(0.0))


def corpus_bleu(df: DataFrame, hyp: str, ref: str, by: list[str] | None = None) -> DataFrame:
    """One row per group with the statistics and ``bleu``."""
    st = bleu_stats(df, hyp, ref, by)
    return st.withColumn("bleu", bleu_score(st))
