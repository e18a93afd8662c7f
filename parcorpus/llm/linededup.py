"""Operator 7: line dedup by repeated runs of lines.

Every document is a sequence of line ids. The suffixes of all sequences are
ranked by distributed prefix doubling: a suffix's rank by its first k lines and
the rank of the suffix k lines on give its rank by 2k lines. Equal ranks are an
interval of the suffix array whose suffixes share at least that many lines (an
LCP interval). Suffixes that share their prefix with no other leave the
ranking, so it works on repeated lines only.

Of an interval, the suffix that comes first in (document id, line) order is the
original; the others are later copies. Copies of at least ``MIN_LINES`` lines,
or of one line of at least ``LONG_LINE_WORDS`` words, are merged into maximal
runs per document and deleted.

Defined results: lines without a word are no part of the sequences; one goes
only where it stands inside a deleted run. A null text has no lines and stays
null. Documents are ordered by (id, text hash), a null id first; rows equal in
id and text are one document given twice and get the same result. Columns named
like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcorpus.llm.common import fingerprint, numbered, words, written

MIN_LINES = 2
LONG_LINE_WORDS = 50
RESULT = ["n_lines", "n_deleted", "runs"]
RUN = "array<struct<start:int,end:int,source:bigint>>"


def _has_word(line: Column) -> Column:
    return line.rlike("[^\\x20\\x09-\\x0D]")


def _lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_id, _text, pos, n, h1, h2, long): every line with a word, by its place among these."""
    worded = F.filter(F.split(F.col(text), "\n"), _has_word)
    seq = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"), worded.alias("_l"))
    rows = seq.select("_id", "_text", F.size("_l").alias("n"), F.posexplode("_l").alias("pos", "line"))
    h1, h2 = fingerprint(F.col("line"))
    # a line of 50 words has at least 99 characters, so most lines need no count
    long = F.when(F.length("line") < 2 * LONG_LINE_WORDS - 1, False).otherwise(
        F.size(words(F.col("line"))) >= LONG_LINE_WORDS)
    return rows.select("_id", "_text", "pos", "n", h1.alias("h1"), h2.alias("h2"), long.alias("long"))


def repeated_prefixes(lines: DataFrame, min_lines: int = MIN_LINES):
    """Yield (length, table) per level of the prefix doubling, until no suffix is left.

    A table has the suffixes whose first ``length`` lines (all their lines, if
    fewer) occur again: (_id, _text, pos, n, long, g, rank, first). ``g`` numbers
    them in document order, ``first`` is the smallest ``g`` of the LCP interval."""
    keys = ["_id", "_text", "pos"]
    lines = written(lines, "lines")
    ids = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c")
    ranked = numbered(ids, ["h1", "h2"], "line-ids", "rank").drop("_total")
    rows = lines.join(ranked, ["h1", "h2"]).groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("long").alias("long"), F.max("rank").alias("rank"))
    rows = numbered(rows, keys, "repeated-lines", "g").drop("_total")
    first = rows.groupBy(F.col("rank").alias("_r")).agg(F.min("g").alias("first"))
    table = rows.join(first, F.col("rank") == F.col("_r")).drop("_r")
    k = 1
    while True:
        table = written(table, f"suffixes-{k}")
        if table.isEmpty():
            return
        yield k, table
        step = min_lines - k if k < min_lines < 2 * k else k
        # the rank of the suffix ``step`` lines on; -1 past the end; null if that suffix is unique, and so this one
        ahead = Window.partitionBy("_id", "_text").orderBy("pos").rangeBetween(step, step)
        paired = table.withColumn("_next", F.when(F.col("pos") + step >= F.col("n"), F.lit(-1)).otherwise(
            F.max("rank").over(ahead))).where(
            # a suffix that ends here is done, and is kept only as the continuation of an earlier one
            F.col("_next").isNotNull() & ((F.col("pos") + k < F.col("n")) | (F.col("pos") >= step)))
        paired = written(paired, f"pairs-{k}")
        classes = paired.groupBy(F.col("rank").alias("_r1"), F.col("_next").alias("_r2")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("g").alias("_first")).where("_c > 1").drop("_c")
        named = numbered(classes, ["_r1", "_r2"], f"ranks-{k}", "_rank").drop("_total")
        table = paired.join(named, (F.col("rank") == F.col("_r1")) & (F.col("_next") == F.col("_r2"))).select(
            *keys, "n", "long", "g", F.col("_rank").alias("rank"), F.col("_first").alias("first"))
        k += step


def deleted_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 min_lines: int = MIN_LINES) -> DataFrame:
    """(_id, _text, runs): per document with a later copy, its maximal runs
    [start, end) over the lines with a word, each with the id of a document
    that holds the start of the run earlier."""
    spans = origin = None
    for k, table in repeated_prefixes(_lines(docs, id_col, text), min_lines):
        if k == 1:
            origin = table.select(F.col("g").alias("_g"), F.col("_id").alias("source"))
        length = F.least(F.lit(k), F.col("n") - F.col("pos"))
        later = table.where((F.col("g") > F.col("first")) & (
            (length >= min_lines) | ((F.lit(k) == 1) & F.col("long")))).select(
            "_id", "_text", "pos", length.alias("length"), "first")
        spans = later if spans is None else spans.unionByName(later)
    if spans is None:
        return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"),
                           F.lit(None).cast(RUN).alias("runs")).limit(0)
    # the longest copy from each line on
    longest = spans.groupBy("_id", "_text", "pos").agg(F.max(F.struct("length", "first")).alias("s")).select(
        "_id", "_text", "pos", "s.length", "s.first")
    told = longest.join(origin, F.col("first") == F.col("_g"))
    per_doc = told.groupBy("_id", "_text").agg(
        F.sort_array(F.collect_list(F.struct("pos", "length", "source"))).alias("_spans"))
    empty = F.array().cast(RUN)

    def merge(found, s):
        end = s["pos"] + s["length"]
        last = F.element_at(found, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"),
                          last["source"].alias("source"))
        new = F.struct(s["pos"].alias("start"), end.alias("end"), s["source"].cast("bigint").alias("source"))
        size = F.size(found)
        return F.when((size > 0) & (F.get(found, size - 1)["end"] >= s["pos"]),
                      F.concat(F.slice(found, 1, F.greatest(size - 1, F.lit(0))), F.array(joined))
                      ).otherwise(F.concat(found, F.array(new)))

    return per_doc.select("_id", "_text", F.aggregate("_spans", empty, merge).alias("runs"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with the later copies of repeated runs deleted from ``text``, and
    ``n_lines`` (with a word), ``n_deleted`` and ``runs``."""
    found = deleted_runs(docs, id_col, text, min_lines).withColumnsRenamed({"_id": "_rid", "_text": "_rtext"})
    clash = {c.lower() for c in RESULT}
    keep = [c for c in docs.columns if c.lower() not in clash]
    df = docs.select(*keep).withColumn("_hash", F.xxhash64(text))
    df = df.join(found, F.col(id_col).eqNullSafe(F.col("_rid")) & (F.col("_hash") == F.col("_rtext")), "left")
    df = df.withColumn("_all", F.split(F.col(text), "\n"))
    df = df.withColumn("_at", F.filter(F.transform(
        "_all", lambda x, i: F.when(_has_word(x), i)), lambda i: i.isNotNull()))
    # what stays: the stretches of raw lines before, between and after the runs
    runs = F.coalesce("runs", F.array().cast(RUN))
    begins = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: F.get("_at", r["end"] - 1) + 1))
    ends = F.concat(F.transform(runs, lambda r: F.get("_at", r["start"])), F.array(F.size("_all")))
    df = df.withColumn("_from", begins).withColumn("_to", ends)
    kept = F.flatten(F.zip_with("_from", "_to", lambda a, b: F.slice("_all", a + 1, F.greatest(b - a, F.lit(0)))))
    gone = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["end"] - r["start"])
    out = df.withColumn("_runs", runs)
    return out.select(
        *[F.when(F.col("runs").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(text)
          if c == text else F.col(c) for c in keep],
        F.greatest(F.size("_at"), F.lit(0)).cast("long").alias("n_lines"),
        gone.cast("long").alias("n_deleted"), F.col("_runs").alias("runs"))
