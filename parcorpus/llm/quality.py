"""Operator 1: host-level quality rules.

Every document is measured by native column expressions (``measure``). Rule
failures are summed by host, each host's failure rate per rule is shrunk
towards an empirical beta prior fitted over all hosts (``host_verdicts``), and
the host verdicts are joined back to the documents (``judge``).

Defined results: a null or empty text has no words and fails the base rules. A
null host is no domain: its documents count for no host and are never rejected
by host. Repeated rows are measured and counted one by one. An empty table
gives an empty result. Columns of the input named like a measure are replaced
by the measure in ``measure``; ``keep_good`` returns the input columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.llm.common import WS_CLASS, words, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 50     # symbols per hundred words
MAX_DUP_LINE_PERCENT = 50   # repeated lines per hundred lines with a word
MAX_HOST_RATE = 0.5         # a host goes when a shrunk failure rate exceeds this
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0  # bounds of the prior's weight in documents
SALTS = 32
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
RULES = {
    "few_words": lambda: F.col("n_words") < MIN_WORDS,
    "repetition": lambda: 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
    "dup_lines": lambda: 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("_n_lines"),
}


def _covered(starts: Column) -> Column:
    """Number of words in the union of 3-word windows at the sorted ``starts``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        starts, zero,
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n")),
        lambda a: a["n"])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of the text. Pure projection: no shuffle, whole texts.

    Repeated windows are found inside each document by sorting its (64-bit
    window hash, position) pairs, only where some hash occurs twice."""
    clash = {c.lower() for c in [*MEASURES, "_n_lines"]}
    keep = [c for c in docs.columns if c.lower() not in clash]
    if text not in keep:
        raise ValueError(f"the text column must not be named {text}")
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(
        *keep,
        words(F.col(text)).alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    n = F.size("_w")
    df = df.withColumn("_h", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))))
    df = df.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda i: F.get("_s", i)["h"]
    df = df.withColumn("_p", F.sort_array(F.filter(F.transform(
        "_s", lambda x, i: F.when((near(i - 1) == x["h"]) | (near(i + 1) == x["h"]), x["i"])),
        lambda p: p.isNotNull())))
    df = df.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("_p")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"))
    return df.withColumn("base_failed", RULES["few_words"]() | RULES["repetition"]())


def host_verdicts(measured: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, shrunk rate of its worst rule, verdict.

    Sums are combined map-side, so a host with a third of all rows is a few
    rows per task. The prior of a rule is fitted by moments over the hosts'
    rates: mean m (weighted by documents), variance v, weight m(1-m)/v - 1."""
    sums = measured.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(rule()).alias(name) for name, rule in RULES.items()])
    long = sums.select("_host", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed")) for name in RULES])).alias("r")
    ).select("_host", "n", "r.rule", "r.failed")
    rate = F.col("failed") / F.col("n")
    moments = long.groupBy("rule").agg(
        (F.sum("failed") / F.sum("n")).alias("m"),
        (F.sum(F.col("n") * rate * rate) / F.sum("n")).alias("m2"))
    v = F.col("m2") - F.col("m") * F.col("m")
    weight = F.when(v > 0, F.greatest(F.lit(PRIOR_MIN), F.least(
        F.lit(PRIOR_MAX), F.col("m") * (1 - F.col("m")) / v - 1))).otherwise(F.lit(PRIOR_MAX))
    prior = moments.select("rule", "m", weight.alias("k"))
    # one row per rule, so this broadcast is bounded
    shrunk = long.join(F.broadcast(prior), "rule").select(
        "_host", "n", ((F.col("failed") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k"))).alias("rate"))
    return shrunk.groupBy("_host").agg(F.max("n").alias("host_docs"), F.max("rate").alias("host_rate")).select(
        "_host", "host_docs", "host_rate", (F.col("host_rate") > max_rate).alias("host_rejected"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", columns: list[str] | None = None,
          max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, host rate and ``kept`` for every row of ``docs``.

    ``columns`` are the input columns to carry (default: all). The measured
    rows are written once below the shared checkpoint folder, so the texts are
    measured once for the host sums and for the result."""
    columns = docs.columns if columns is None else columns
    clash = {c.lower() for c in [*MEASURES, "_n_lines", "_host"]}
    carry = [c for c in columns if c.lower() not in clash]
    m = written(measure(docs.select(*dict.fromkeys([*carry, text, host])), text).select(
        *dict.fromkeys([*carry, host]), *MEASURES, "_n_lines"), "quality")
    # a host with a third of all rows is spread over SALTS keys; the verdicts are one small row per host
    salts = host_verdicts(m, host, max_rate).select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salt = F.pmod(F.xxhash64(*[m[c] for c in MEASURES]), F.lit(SALTS))
    out = m.join(salts, (m[host] == F.col("_host")) & (salt == F.col("_s")), "left")
    return out.select(
        *[m[c] for c in carry], *MEASURES, "host_rate",
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns unchanged."""
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"), F.col(host).alias("_from"))
    return judge(packed, "_text", "_from", ["_doc"], max_rate).where("kept").select("_doc.*")
