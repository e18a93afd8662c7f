"""Views over the driver's test tables that give the corpus operators their
input shapes (the test tables hold no parallel text of their own).

Each view is plain DataFrame code over the parquet tables, so its work grows with
them; ``plans/oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcorpus.functions import text as T

# Versions of the verse corpus = document languages, in this fixed order.
VERSIONS = ["en", "fr", "de", "es"]
# Rows per batch in the log view (fixed value, as the batch size of the runs).
LOG_BATCH = 30
LOG_WORKERS = 14


# Place values of ``pos``: (document, line) and (conversation, turn) as one
# decimal. A text has fewer than 2**31 lines (Spark's array limit), so places
# never meet; a decimal of this size is a fixed-width value for aggregations.
LINES = 1 << 31
TURNS = 10 ** 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a test table. Splits come from the scan alone
    (``spark.sql.files.maxPartitionBytes``), at every size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def place(major: str, minor, width: int) -> F.Column:
    """``pos``: the place of (major, minor) in order."""
    w = F.lit(width).cast("decimal(19,0)")
    return (F.col(major).cast("decimal(19,0)") * w + minor).cast("decimal(38,0)")


def book_id(source) -> F.Column:
    """A number for a source: 60 bits of its md5."""
    return F.conv(F.substring(F.md5(source), 1, 15), 16, 10).cast("long")


def verses_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long corpus: version = lang, book = source, chapter = doc_id div 100,
    verse = 1-based line number, in the order of (doc_id, verse)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lines = docs.select(
        F.col("lang").alias("version"), book_id("source").alias("book_id"),
        F.col("source").alias("book_name"), F.expr("cast(doc_id div 100 as int)").alias("chapter"),
        "doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    return lines.select(
        "version", "book_id", "book_name", "chapter", (F.col("i") + 1).cast("int").alias("verse"), "text",
        "doc_id", place("doc_id", F.col("i"), LINES).alias("pos"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book dimension (name, id, ordinal) from the documents' sources; the
    ordinal is the number in the source's name, sources without one come last."""
    docs = table(spark, sf_dir, "documents").select("source").distinct()
    number = F.regexp_extract("source", "[0-9]+", 0).try_cast("int")
    return docs.select(F.col("source").alias("name"), book_id("source").alias("id"),
                       F.coalesce(number, F.lit((1 << 31) - 1)).alias("ordinal"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence pairs: a user turn and the assistant turn right after it.

    Self-join on the composite key (conv_id, turn): every key is unique, so a
    very long conversation does not land in one task."""
    conv = table(spark, sf_dir, "conversations")
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("en"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    return u.join(a, ["conv_id", "turn"], "inner").select(
        "conv_id", "turn", "en", "target", place("conv_id", F.col("turn"), TURNS).alias("pos"))


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with the line after it (the last with the
    first), in the order of (doc_id, line)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    lines = F.split("text", "\n")
    after = F.concat(F.slice("_l", 2, F.greatest(F.size("_l") - 1, F.lit(0))), F.slice("_l", 1, 1))
    two = docs.select("doc_id", "lang", lines.alias("_l")).select(
        "doc_id", "lang", F.posexplode(F.zip_with("_l", after, lambda a, b: F.struct(
            a.alias("src"), b.alias("tgt")))).alias("line", "_p"))
    return two.select("doc_id", "line", "lang", "_p.src", "_p.tgt", place("doc_id", F.col("line"), LINES).alias("pos"))


def translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translation triples over all lines, with failure markers set by rule on
    (doc_id + line) % 10: 0 -> [ERROR], 1 -> untranslated (tl = sl), 2 -> failed,
    3 -> back-translation; otherwise tl = the next line. ol = the next line."""
    dp = doc_pairs(spark, sf_dir)
    r = (F.col("doc_id") + F.col("line")) % 10
    tl = (F.when(r == 0, F.lit(T.MARKER_ERROR))
          .when(r == 1, F.col("src"))
          .when(r == 2, F.concat(F.lit(T.MARKER_FAILED + " - "), F.col("src")))
          .when(r == 3, F.concat(F.lit(T.MARKER_BACK_PREFIX + "en] - "), F.col("src")))
          .otherwise(F.col("tgt")))
    return dp.select("doc_id", "line", F.col("src").alias("sl"), tl.alias("tl"),
                     F.col("tgt").alias("ol"), "pos")


def chapter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pages in the markup of a chapter page: every ``<p>`` paragraph
    is a verse container with a content element, a label (its number, from 1;
    every third has none) and, every fourth, a note. A page without paragraphs
    has the not-available element."""
    pieces = F.split("html", "<p>")
    pieces = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def container(p, i):
        label = F.when(i % 3 != 2, F.concat(
            F.lit('<span class="ChapterContent_label__R2PLt">'), (i + 1).cast("string"), F.lit("</span>"))).otherwise("")
        note = F.when(i % 4 == 3, F.lit('<span class="ChapterContent_note__YlDW0">#</span>')).otherwise("")
        return F.concat(F.lit('<div class="ChapterContent_verse__57FIw">'), label,
                        F.lit('<span class="ChapterContent_content__RrUqA">'),
                        F.substring_index(p, "</p>", 1), F.lit("</span>"), note, F.lit("</div>"))

    body = F.when(F.size(pieces) > 0, F.array_join(F.transform(pieces, container), "\n")).otherwise(
        F.lit('<span class="ChapterContent_not-avaliable-span__WrOM_">none</span>'))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("<main>"), body, F.lit("</main>")).alias("html"))


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pages in the markup of a result table: every ``<li><a>`` item
    is a row of class ``odd`` or ``even``, in turn, with its address and its text
    as cells."""
    row = ('<tr class="{}"><td>$1</td>\n<td>$2</td></tr>')
    item = r'(?s)<li><a href="([^"]*)">(.*?)</a></li>'
    items = F.regexp_extract_all("html", F.lit(item), 0)
    rows = F.transform(items, lambda x, i: F.when(i % 2 == 0, F.regexp_replace(x, item, row.format("odd"))).otherwise(
        F.regexp_replace(x, item, row.format("even"))))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("<table>"), F.array_join(rows, "\n"), F.lit("</table>")).alias("html"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log text lines ``ts [LEVEL] Worker w | Batch i/N | message`` built from
    events; N is the number of batches."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    # scalar subquery: one value, computed by its own aggregate job
    n = ev.agg(((F.max("event_id") / LOG_BATCH).cast("long") + 1).alias("n")).scalar()
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ["), F.upper("event_type"),
        F.lit("] Worker "), (F.col("user_id") % LOG_WORKERS).cast("string"),
        F.lit(" | Batch "), (F.col("event_id") / LOG_BATCH).cast("long").cast("string"),
        F.lit("/"), n.cast("string"), F.lit(" | "), F.col("props"))
    return ev.select(F.col("event_id").alias("line_no"), line.alias("value"))
