"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole test tables through ``views`` and runs one or more
library operators; array-valued results are rendered as delimited strings so
the DuckDB oracle can produce byte-identical values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcorpus.functions import text as TX
from parcorpus.operators import (align, batching, bleu, dedup, joins, prep, report, schema,
                                  segment, udf)
from parcorpus.plans import views as V
from parcorpus.sources import dims, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.merge_versions(V.verses_long(spark, sf_dir), V.VERSIONS)


def _join_versions(col) -> F.Column:
    return F.array_join(col, ",")


# --------------------------------------------------------------------------
# Alignment (G1-G9, J-3, J-4, J-6, B8, L1)
# --------------------------------------------------------------------------
@query
def merge_versions(spark, sf_dir):
    return _wide(spark, sf_dir)


@query
def merge_stats(spark, sf_dir):
    long = V.verses_long(spark, sf_dir)
    return align.merge_stats(long, align.merge_versions(long, V.VERSIONS), V.VERSIONS)


@query
def verse_counts(spark, sf_dir):
    return align.verse_counts(_wide(spark, sf_dir), V.VERSIONS).select(
        "book_name", "chapter", "version", "n")


@query
def chapter_consistency(spark, sf_dir):
    return align.chapter_status(_wide(spark, sf_dir), V.VERSIONS)


@query
def majority_outliers(spark, sf_dir):
    mo = align.majority_outliers(_wide(spark, sf_dir), V.VERSIONS)
    return mo.select(
        "book_name", "chapter", "majority",
        F.array_join(F.transform("counts", lambda x: F.concat(x["version"], F.lit(":"),
                                                               x["n"].cast("string"))), ",")
        .alias("counts"),
        _join_versions(F.col("outliers")).alias("outliers"))


@query
def verse_length_stats(spark, sf_dir):
    return align.verse_length_stats(_wide(spark, sf_dir), V.VERSIONS).select(
        *align.VERSE_KEY, "n_versions", F.round("mean_len", 6).alias("mean_len"))


@query
def first_suspicious_verse(spark, sf_dir):
    sv = align.suspicious_verses(_wide(spark, sf_dir), V.VERSIONS)
    return sv.select(
        "book_name", "chapter", "split_verse",
        _join_versions(F.col("suspects")).alias("suspects"),
        F.array_join(F.transform("lengths", lambda x: F.concat(x["version"], F.lit(":"),
                                                                x["len"].cast("string"))), ",")
        .alias("lengths"))


@query
def salvage(spark, sf_dir):
    return align.salvage(_wide(spark, sf_dir), V.VERSIONS).select(
        *align.VERSE_KEY, "label")


@query
def alignment_report(spark, sf_dir):
    rep = align.alignment_report(_wide(spark, sf_dir), V.VERSIONS)
    return rep.select(
        "book_name", "chapter", "majority", "split_verse", "n_good", "n_suspect",
        F.array_join(F.transform("counts", lambda x: F.concat(x["version"], F.lit(":"),
                                                               x["n"].cast("string"))), ",")
        .alias("counts"),
        _join_versions(F.col("outliers")).alias("outliers"),
        _join_versions(F.col("suspects")).alias("suspects"))


@query
def canonical_order(spark, sf_dir):
    """L1: the corpus in canonical order, each row with its place in the output."""
    wide = _wide(spark, sf_dir).select("book_name", "book_id", "chapter", "verse", "en_text")
    return dedup.with_place(align.canonical_sort(wide, V.books(spark, sf_dir)).select(
        "book_ord", "book_name", "chapter", "verse", "en_text"))


# --------------------------------------------------------------------------
# De-duplication and the incremental corpus (F1-F5, C5, C6, J-1, U2, A5, G14)
# --------------------------------------------------------------------------
@query
def split_duplicates(spark, sf_dir):
    return dedup.split_duplicates(V.doc_pairs(spark, sf_dir), ["src", "tgt", "lang"]).select(
        "doc_id", "line", "is_duplicate")


@query
def cross_seen_duplicates(spark, sf_dir):
    return dedup.cross_seen(V.doc_pairs(spark, sf_dir), "src", "tgt").select(
        "doc_id", "line", "is_duplicate")


@query
def mark_all_duplicates(spark, sf_dir):
    return dedup.mark_all_duplicates(V.doc_pairs(spark, sf_dir), ["src", "tgt"]).select(
        "doc_id", "line", "is_duplicate")


@query
def keep_first(spark, sf_dir):
    return dedup.keep_first(V.doc_pairs(spark, sf_dir), ["src", "tgt"]).select(
        "doc_id", "line", "src", "tgt")


@query
def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(dedup.split_duplicates(V.doc_pairs(spark, sf_dir), ["src", "tgt"]))


@query
def clean_corpus(spark, sf_dir):
    return dedup.clean_corpus(V.translations(spark, sf_dir)).select("doc_id", "line", "sl", "tl", "ol")


@query
def drop_untranslated(spark, sf_dir):
    return dedup.drop_untranslated(V.translations(spark, sf_dir)).select("doc_id", "line", "sl", "tl")


@query
def translation_status(spark, sf_dir):
    t = V.translations(spark, sf_dir)
    return t.select("doc_id", "line", TX.parse_status("tl").alias("s")).select(
        "doc_id", "line", "s.status", "s.lang", "s.payload")


@query
def translation_stats(spark, sf_dir):
    return report.translation_stats(V.translations(spark, sf_dir))


@query
def failure_report(spark, sf_dir):
    return dedup.failure_report(V.translations(spark, sf_dir))


@query
def minus_existing(spark, sf_dir):
    new = V.doc_pairs(spark, sf_dir).select("doc_id", "line", F.col("src").alias("sl"),
                                            F.col("tgt").alias("ol"))
    corpus = dedup.clean_corpus(V.translations(spark, sf_dir))
    return joins.minus_existing(new, corpus, ["sl", "ol"])


@query
def append_corpus(spark, sf_dir):
    new = V.doc_pairs(spark, sf_dir).select(
        "doc_id", "line", F.col("src").alias("sl"), F.col("tgt").alias("tl"), F.col("tgt").alias("ol"), "pos")
    old = dedup.clean_corpus(V.translations(spark, sf_dir).drop("ol"))  # a column that the result does not have
    return joins.append_corpus(new, old).select("doc_id", "line", "gen", "sl", "tl", "is_duplicate")


@query
def read_many(spark, sf_dir):
    dp = V.doc_pairs(spark, sf_dir).select("src", "tgt", "pos")
    pr = V.pairs(spark, sf_dir).select(F.col("en").alias("src"), F.col("target").alias("tgt"), "pos")
    return joins.read_many([dp, pr], "src", "tgt").select("dataset", "src", "tgt")


# --------------------------------------------------------------------------
# Logs (A9, C12, G12, G15)
# --------------------------------------------------------------------------
def _parsed_log(spark, sf_dir):
    return readers.parse_log(V.log_lines(spark, sf_dir))


@query
def log_by_batch(spark, sf_dir):
    return _parsed_log(spark, sf_dir).groupBy("worker", "batch", "total").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("ts").alias("first_ts"))


@query
def batch_errors(spark, sf_dir):
    return report.batch_errors(_parsed_log(spark, sf_dir))


@query
def log_kept_ratio(spark, sf_dir):
    return report.log_kept_ratio(_parsed_log(spark, sf_dir))


@query
def filter_log(spark, sf_dir):
    """The lines of every batch, found by its full prefix."""
    lines = _parsed_log(spark, sf_dir)
    return readers.filter_log(lines, F.col("worker"), F.col("batch"), F.col("total")).select(
        "worker", "batch", "line_no", "value")


@query
def log_batch_lines(spark, sf_dir):
    """C12 after the split: the folders of one worker's batches are the only ones read for its first batch."""
    path = _fresh(spark, "logs")
    parsed = _parsed_log(spark, sf_dir)
    readers.split_log_by_batch(parsed, path, buckets=8)
    first = parsed.where(F.col("worker") == 1).agg(F.min("batch")).first()[0]
    return readers.read_log_batch(spark, path, 1, -1 if first is None else first, buckets=8)


# --------------------------------------------------------------------------
# Training-set preparation
# --------------------------------------------------------------------------
TARGETS = {"fr_text": "fr", "de_text": "de", "es_text": "es"}


def _valid_pairs(spark, sf_dir):
    return joins.union_languages(_wide(spark, sf_dir), "en_text", TARGETS)


@query
def valid_pairs(spark, sf_dir):
    return _valid_pairs(spark, sf_dir)


@query
def pair_counts(spark, sf_dir):
    return report.pair_counts(_valid_pairs(spark, sf_dir))


@query
def training_prompts(spark, sf_dir):
    return schema.add_prompt(_valid_pairs(spark, sf_dir), "tag", strip_text=True)


@query
def hash_split(spark, sf_dir):
    return prep.hash_split(_valid_pairs(spark, sf_dir), ["en", "target", "language"])


@query
def exact_split(spark, sf_dir):
    pr = V.pairs(spark, sf_dir).select("conv_id", "turn", "en", "target")
    return prep.exact_split(pr, ["en", "target"]).select("conv_id", "turn", "split")


@query
def exact_split_floor(spark, sf_dir):
    pr = V.pairs(spark, sf_dir).select("conv_id", "turn", "en", "target")
    return prep.exact_split(pr, ["en", "target"], rule="floor_train").select("conv_id", "turn", "split")


#: Entries of the vocabulary, reserved ids included, and tokens of an encoded side: parameters of the model to train.
VOCAB_SIZE = 32_000
MAX_LEN = 128


def _vocab(spark, sf_dir):
    return prep.build_vocab(V.table(spark, sf_dir, "documents"), ["text"], VOCAB_SIZE)


@query
def vocab(spark, sf_dir):
    return _vocab(spark, sf_dir)


def _encoded(spark, sf_dir):
    pr = schema.add_prompt(schema.tag_language(V.pairs(spark, sf_dir), "kw"), "tag")
    return prep.encode_fixed(pr, _vocab(spark, sf_dir), "prompt", "target", MAX_LEN)


def _ints(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


@query
def encode_fixed(spark, sf_dir):
    return _encoded(spark, sf_dir).select(
        "conv_id", "turn", _ints("input_ids").alias("input_ids"),
        _ints("attention_mask").alias("attention_mask"), _ints("labels").alias("labels"))


@query
def decode_ids(spark, sf_dir):
    enc = _encoded(spark, sf_dir)
    return prep.decode_ids(enc, "labels", _vocab(spark, sf_dir), "decoded").select(
        "conv_id", "turn", "decoded")


# --------------------------------------------------------------------------
# BLEU (G16)
# --------------------------------------------------------------------------
def _bleu_out(df):
    return df.select(*[c for c in df.columns if c != "bleu"], F.round("bleu", 6).alias("bleu"))


@query
def corpus_bleu(spark, sf_dir):
    pr = V.pairs(spark, sf_dir)
    return _bleu_out(bleu.corpus_bleu(pr, "en", "target", ["conv_id"]))


@query
def corpus_bleu_docs(spark, sf_dir):
    dp = V.doc_pairs(spark, sf_dir)
    return _bleu_out(bleu.corpus_bleu(dp, "src", "tgt", ["lang"]))


# --------------------------------------------------------------------------
# Tasks, batches, requests, translation (T4-T8, J-2, X1)
# --------------------------------------------------------------------------
def _books_dim(spark, sf_dir):
    """Books = document sources; a book's chapter count = its distinct
    chapters in the corpus (grows with the documents table)."""
    long = V.verses_long(spark, sf_dir)
    return long.groupBy("book_name", "book_id").agg(
        F.count_distinct("chapter").cast("int").alias("chapters")).select(
        F.col("book_name").alias("book"), "book_id", "chapters")


@query
def chapter_ranges(spark, sf_dir):
    return batching.chapter_ranges(_books_dim(spark, sf_dir), max_chapters=30).select(
        "book_id", "range_index", "start_chapter", "end_chapter")


@query
def task_table(spark, sf_dir):
    ranges = batching.chapter_ranges(_books_dim(spark, sf_dir), max_chapters=30)
    versions = V.table(spark, sf_dir, "documents").select("lang")
    return batching.task_table(ranges, versions, "lang", ["book_id", "range_index"]).select(
        "task_id", "version", "book_id", "start_chapter", "end_chapter")


def _sentence_pairs(spark, sf_dir):
    return V.doc_pairs(spark, sf_dir).select("doc_id", "line", F.col("src").alias("sl"), F.col("tgt").alias("ol"))


LINE = ["doc_id", "line"]


@query
def batches(spark, sf_dir):
    return batching.make_batches(_sentence_pairs(spark, sf_dir), LINE).select("doc_id", "line", "rn", "batch_id")


def _requests(spark, sf_dir):
    return batching.make_requests(batching.make_batches(_sentence_pairs(spark, sf_dir), LINE))


@query
def requests(spark, sf_dir):
    return _requests(spark, sf_dir).select("batch_id", "chunk_id", "n_sentences", "request")


ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


@query
def realign(spark, sf_dir):
    req = _requests(spark, sf_dir)
    res = req.withColumn("translated", F.translate("request", ASCII_LOWER, ASCII_LOWER.upper()))
    return batching.realign(res)


def ascii_upper_fn():
    """Deterministic stand-in translator (ASCII upper-casing), built as a
    closure so the Python workers receive it by value."""
    table = str.maketrans(ASCII_LOWER, ASCII_LOWER.upper())

    def fn(s: str) -> str:
        return s.translate(table)

    return fn


@query
def translate_batches(spark, sf_dir):
    return udf.translate_batches(_sentence_pairs(spark, sf_dir), ascii_upper_fn(), order=LINE)


def pair_answer_fn():
    """Stand-in translator that answers (sources, targets)."""
    table = str.maketrans(ASCII_LOWER, ASCII_LOWER.upper())

    def fn(s: str):
        parts = s.split("<|||>")
        return parts, [p.translate(table) for p in parts]

    return fn


@query
def translate_pairs(spark, sf_dir):
    """X1/T8 with pair answers."""
    return udf.translate_batches(_sentence_pairs(spark, sf_dir), pair_answer_fn(), order=LINE)


@query
def map_batched(spark, sf_dir):
    """A vectorised batch function (words per text) over the documents."""
    def count_words(pdf):
        return pdf.assign(n_words=pdf["text"].str.split().str.len().astype("int64"))[["doc_id", "n_words"]]

    return udf.map_batched(_docs(spark, sf_dir), count_words, "doc_id long, n_words long")


# --------------------------------------------------------------------------
# Pages, segments, text functions
# --------------------------------------------------------------------------
@query
def extract_verses(spark, sf_dir):
    return segment.extract_verses(V.chapter_pages(spark, sf_dir))


@query
def extract_table_pairs(spark, sf_dir):
    return segment.extract_table_pairs(V.table_pages(spark, sf_dir))


@query
def page_not_found(spark, sf_dir):
    pages = V.chapter_pages(spark, sf_dir)
    return pages.select("page_id", segment.page_status().alias("status"))


def _benchmark_lines(spark, sf_dir):
    b = V.table(spark, sf_dir, "benchmark")
    return b.select(F.explode(F.split("text", "\n")).alias("text"))


@query
def curate_text(spark, sf_dir):
    lines = V.verses_long(spark, sf_dir).select("doc_id", "verse", "text")
    return segment.curate_segments(lines, "text", _benchmark_lines(spark, sf_dir)).select("doc_id", "verse", "label")


@query
def exclude_sentences(spark, sf_dir):
    lines = V.verses_long(spark, sf_dir).select("doc_id", "text")
    kept = joins.exclude_sentences(lines, _benchmark_lines(spark, sf_dir), "text")
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept_lines"))


@query
def nested_pairs(spark, sf_dir):
    dp = joins.drop_null_pairs(V.doc_pairs(spark, sf_dir), "src", "tgt")
    nested = schema.to_nested(dp.select("doc_id", F.col("src").alias("br"), F.col("tgt").alias("en")),
                              "br", "en")
    return nested.select(F.col("translation.br").alias("br"), F.col("translation.en").alias("en"))


def _docs(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", "text")


@query
def clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.clean_text("text").alias("cleaned"))


@query
def collapse_ws(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.collapse_ws("text").alias("collapsed"))


@query
def strip_text(spark, sf_dir):
    conv = V.table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", TX.strip("text").alias("stripped"),
                       TX.preview_text("text", 50).alias("preview"),
                       TX.text_length("text").alias("n_chars"))


@query
def quotes(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.quotes_to_single("text").alias("text"))


@query
def sanitize_name(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return pages.select("page_id", TX.sanitize_name(title).alias("title_name"),
                        TX.sanitize_name("url").alias("url_name"))


@query
def url_params(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    m = TX.url_params("url")
    rendered = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), F.array_join(e["value"], "|"))), ";")
    return pages.select("page_id", rendered.alias("params"), TX.url_param("url", "page").alias("page"))


@query
def query_param_mismatch(spark, sf_dir):
    """The documents' translator URLs against the pair French to English."""
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "lang")
    url = TX.translator_url(F.col("lang"), F.lit("en"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", url.alias("url"), TX.query_param_mismatch(url, "fr", "en").alias("mismatch"))


@query
def url_language_check(spark, sf_dir):
    """The language in a page's address against the one its markup declares."""
    pages = V.table(spark, sf_dir, "pages")
    url_lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z][a-z])/", 1)
    page_lang = F.regexp_extract("html", r'<html lang="([^"]*)"', 1)
    return pages.select("page_id", url_lang.alias("url_lang"), page_lang.alias("page_lang"),
                        (url_lang != page_lang).alias("mismatch"))


@query
def chapter_url(spark, sf_dir):
    """P10 per (version, book, chapter) of the corpus: version id = position
    in the version list, abbreviation = first three letters of the book,
    chapter numbered from 1, suffix = upper-case version."""
    vid = F.create_map(*[F.lit(x) for i, v in enumerate(V.VERSIONS) for x in (v, i + 1)])
    ch = V.verses_long(spark, sf_dir).select("version", "book_name", "chapter").distinct()
    parts = ch.select("version", "book_name", "chapter",
                      vid[F.col("version")].alias("version_id"),
                      F.upper(F.substring("book_name", 1, 3)).alias("abbr"),
                      (F.col("chapter") + 1).alias("chapter_no"), F.upper("version").alias("suffix"))
    return schema.with_chapter_url(parts, chapter="chapter_no").select(
        "version", "book_name", "chapter", "url")


@query
def translator_url(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.select("doc_id", TX.translator_url(F.col("lang"), F.lit("en"),
                                                   F.col("doc_id").cast("string")).alias("url"),
                       TX.language_name("lang").alias("language"))


# --------------------------------------------------------------------------
# Profiles, previews, exports, previous runs, streaming ingest
# (G13, G18, L5, B7, A6, F6, F7, J-5, R1)
# --------------------------------------------------------------------------
@query
def table_profile(spark, sf_dir):
    conv = schema.require_columns(V.table(spark, sf_dir, "conversations"), ["conv_id", "text"])
    return report.table_profile(conv)


@query
def preview(spark, sf_dir):
    return prep.preview(_wide(spark, sf_dir), ["book_id", "chapter", "verse"], 5).select(
        "book_name", "chapter", "verse", "en_text")


@query
def version_books(spark, sf_dir):
    return align.version_books(V.verses_long(spark, sf_dir))


@query
def render_text(spark, sf_dir):
    return report.render_text(V.verses_long(spark, sf_dir), V.books(spark, sf_dir)).select(
        "version", "book_ord", "chapter", "kind", "verse", "seq", "value")


def _runs(spark, sf_dir):
    """Run table from events: one run per day, stamped YYYYmmdd_HHMMSS."""
    ev = V.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return ev.withColumn("run_id", TX.run_stamp(F.date_trunc("day", "ts")))


@query
def latest_run(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    rank = dedup.run_rank(runs)
    second = rank.where(F.col("run_rank") == 2).select("run_id")
    return runs.join(second, "run_id", "left_semi").select("event_id", "run_id")


@query
def newest_per_key(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return dedup.newest_per_key(runs, ["user_id"], "ts").select("user_id", "event_id", "run_id")


@query
def todo_tasks(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    tasks = runs.select("event_type", "user_id").distinct()
    last = dedup.run_rank(runs).where(F.col("run_rank") == 1).select("run_id")
    done = runs.join(last, "run_id", "left_semi").select("event_type", "user_id")
    return joins.todo_tasks(tasks, done, ["event_type", "user_id"])


#: Micro-batches of the ingest, and about how many rows a part file holds at most.
MICRO_BATCHES, PARTIAL_ROWS = 4, 100_000


@query
def ingest_partials(spark, sf_dir):
    """R1 end to end: the translation table is written as JSON part files into
    a fresh folder under the checkpoint directory, ingested by the stream in
    several micro-batches, and the resulting corpus is returned.

    The part files are as many as the rows ask for, so that none holds more of them
    than :data:`PARTIAL_ROWS`; a micro-batch takes its share of the files, so that
    there are as many micro-batches at any size. The files are compressed, and each
    task of the scan cuts its rows into files as they come: no row is dealt out for it."""
    import uuid

    from parcorpus.session import scratch_path
    from parcorpus.sources import manifest
    from parcorpus.streaming import ingest
    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    src, out, ck = f"{base}/partials", f"{base}/corpus", f"{base}/checkpoint"
    tr = V.translations(spark, sf_dir).select("sl", "tl", "ol", "pos")
    # several files for each micro-batch, or their shares would be uneven
    at_most = min(PARTIAL_ROWS, max(1, -(-tr.count() // MICRO_BATCHES ** 2)))
    tr.write.mode("overwrite").option("compression", "lz4").option("maxRecordsPerFile", at_most).json(src)
    files = sum(n.startswith("part-") for n in manifest.names(spark, src))
    q = ingest.start_ingest(spark, src, out, ck, available_now=True, max_files_per_trigger=max(1, -(-files // MICRO_BATCHES)))
    q.awaitTermination()
    return ingest.read_corpus(spark, out).select("sl", "tl")


# --------------------------------------------------------------------------
# Remaining predicates and helpers (C7, J-6, J-7, S12, S14, T11, S16-S18)
# --------------------------------------------------------------------------
@query
def degenerate_translations(spark, sf_dir):
    t = V.translations(spark, sf_dir)
    return t.select("doc_id", "line", TX.is_degenerate_translation("tl", "sl").alias("degenerate"),
                    TX.is_degenerate_translation("tl", "sl", case_insensitive=False).alias("same_exact"))


@query
def range_label(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    return align.range_label(wide, align.chapter_facts(wide, V.VERSIONS)).select(*align.VERSE_KEY, "side")


@query
def zip_lines(spark, sf_dir):
    pr = V.pairs(spark, sf_dir).select("conv_id", "turn", F.split("en", "\n").alias("a"),
                                       F.split("target", "\n").alias("b"))
    z = joins.zip_pairs(pr, "a", "b")
    return z.select("conv_id", "turn", F.posexplode("pair").alias("i", "p")).select(
        "conv_id", "turn", "i", F.col("p.a").alias("a"), F.col("p.b").alias("b"))


@query
def tmx_blocks(spark, sf_dir):
    dp = V.doc_pairs(spark, sf_dir)
    block = F.format_string('<tu>\n<tuv xml:lang="br"><seg>%s</seg></tuv>\n'
                            '<tuv xml:lang="en"><seg>%s</seg></tuv>\n</tu>', "src", "tgt")
    blocks = dp.select("doc_id", "line", block.alias("block"))
    cur = segment.curate_tmx_blocks(blocks, _benchmark_lines(spark, sf_dir))
    return cur.select("doc_id", "line", "label", TX.tmx_segment(F.col("block"), "en").alias("en"))


@query
def name_parts(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages").select("page_id", "url")
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z][a-z])/", 1)
    return pages.select(
        "page_id",
        TX.remove_prefix(TX.remove_prefix(F.col("url"), "https://"), "http://").alias("no_scheme"),
        TX.file_stem("url").alias("stem"),
        TX.version_text_key(lang).alias("text_key"),
        TX.split_tab(F.concat_ws("\t", lang, F.col("url")))["first"].alias("tab_first"))


@query
def alignment_report_text(spark, sf_dir):
    """B8 as text: one readable block per inconsistent chapter."""
    rep = align.alignment_report(_wide(spark, sf_dir), V.VERSIONS)
    return align.report_text(rep)


# --------------------------------------------------------------------------
# Sources and sinks: written below the shared checkpoint folder, read back
# (A1-A4, A6-A8, B1-B6, B9, C12)
# --------------------------------------------------------------------------
def _fresh(spark, name: str) -> str:
    import uuid

    from parcorpus.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _translations(spark, sf_dir):
    return V.translations(spark, sf_dir).drop("pos").withColumn("key", F.concat_ws("-", "doc_id", "line"))


@query
def read_json_arrays(spark, sf_dir):
    """A1: files that hold one JSON array each (the documents by hundreds)."""
    path = _fresh(spark, "json-arrays")
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    arrays = docs.groupBy(F.expr("doc_id div 100").alias("part")).agg(
        F.to_json(F.sort_array(F.collect_list(F.struct("doc_id", "lang", "text")))).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(path)
    schema_ = spark.createDataFrame([], "doc_id long, lang string, text string").schema
    return readers.read_corpus_json(spark, path, schema_).select("doc_id", "lang", "text", readers.CORRUPT)


@query
def write_json(spark, sf_dir):
    """B1: unique and duplicate pairs in one job."""
    path = _fresh(spark, "json")
    tr = V.translations(spark, sf_dir).select("doc_id", "line", "sl", "tl", "pos", F.lit("x").alias("scratch"))
    sinks.write_json(tr, path, keys=["sl", "tl"], save_duplicates=True, keys_to_remove=["scratch"])
    return spark.read.schema("doc_id long, line int, sl string, tl string, part string").json(path)


@query
def csv_round_trip(spark, sf_dir):
    """B2 and A2: cleaned CSV with a status column, read back."""
    path = _fresh(spark, "csv")
    sinks.write_csv(_translations(spark, sf_dir), path, ["key", "sl", "tl", "note"])
    return readers.read_corpus_csv(spark, path, ["key", "sl", "tl", "note", "status"])


@query
def quoted_csv(spark, sf_dir):
    """Every field quoted."""
    path = _fresh(spark, "quoted")
    sinks.write_quoted_csv(_valid_pairs(spark, sf_dir).select("en", "target"), path)
    return readers.read_corpus_csv(spark, path, ["en", "target"])


@query
def read_tmx(spark, sf_dir):
    """A3: translation-memory files written from the line pairs."""
    path = _fresh(spark, "tmx")

    def xml(c):
        c = F.replace(F.col(c), F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    units = V.doc_pairs(spark, sf_dir).select(F.expr("doc_id div 100").alias("part"), F.format_string(
        '<tu><tuv xml:lang="br"><seg>%s</seg></tuv><tuv xml:lang="en"><seg>%s</seg></tuv></tu>',
        xml("src"), xml("tgt")).alias("tu"))
    files = units.groupBy("part").agg(F.concat(
        F.lit("<tmx><body>"), F.array_join(F.collect_list("tu"), ""), F.lit("</body></tmx>")).alias("value"))
    files.repartition("part").write.partitionBy("part").text(path)
    return readers.read_tmx(spark, path, "br", "en")


@query
def read_pairs(spark, sf_dir):
    """A4: a stored pair table, blank rows dropped, first of equal pairs kept."""
    path = _fresh(spark, "pairs")
    V.doc_pairs(spark, sf_dir).write.parquet(path)
    return readers.read_pairs(spark, path, "src", "tgt", order="pos").select("src", "tgt")


@query
def previous_run(spark, sf_dir):
    """Three runs are written, the second-last is read."""
    path = _fresh(spark, "runs")
    tr = _translations(spark, sf_dir)
    for k, stamp in enumerate(("2024-01-01 10:00:00", "2024-01-02 09:30:00", "2024-01-03 09:00:00")):
        sinks.write_run(tr.where(F.col("doc_id") % 3 == k), path, stamp)
    schema_ = spark.createDataFrame([], "doc_id long, line int, sl string, tl string").schema
    return readers.read_previous_run(spark, path, "*.json", schema=schema_).select("run_id", "doc_id", "line", "sl", "tl")


@query
def version_names(spark, sf_dir):
    """The version dimension from caller rows, joined with the documents."""
    dim = dims.version_dim(spark, [{"text": v, "suffix": v.upper(), "id": i, "language": v, "name": f"Version {v}",
                                    "file": f"{v}.json"} for i, v in enumerate(V.VERSIONS)])
    docs = V.table(spark, sf_dir, "documents").select("lang")
    return docs.join(dim, docs["lang"] == dim["language"]).groupBy("name", "id").agg(
        F.count(F.lit(1)).alias("n_documents"))


@query
def read_pages(spark, sf_dir):
    """The stored pages."""
    pages = readers.read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").alias("html_chars"))


@query
def write_partials(spark, sf_dir):
    """Translated rows of complete batches only, in groups of batches."""
    path = _fresh(spark, "partials")
    tr = _translations(spark, sf_dir).withColumn("batch_id", F.col("doc_id"))
    sinks.write_partials(tr, path, only_complete=True)
    return sinks.read_partials(spark, path).select("batch_id", "doc_id", "line", "sl", "tl")


@query
def split_outputs(spark, sf_dir):
    """Train and test written in one job, and the rows counted."""
    path = _fresh(spark, "split")
    labelled = prep.hash_split(V.pairs(spark, sf_dir).select("conv_id", "turn", "en", "target"), ["en", "target"])
    sinks.split_outputs(labelled, "split", path)
    back = spark.read.schema("conv_id long, turn long, en string, target string, split string").json(path)
    whole = sinks.verify_written(spark, path, labelled.count())
    return back.select("conv_id", "turn", "split", F.lit(whole).alias("verified"))


@query
def log_of_batch(spark, sf_dir):
    """C12 for all batches at once: written by worker and bucket of batches, read back whole."""
    path = _fresh(spark, "logs")
    readers.split_log_by_batch(_parsed_log(spark, sf_dir), path)
    back = spark.read.schema("worker int, batch int, value string, bucket int").json(path)
    return back.groupBy("worker", "batch").agg(F.count(F.lit(1)).alias("n_lines"))


# --------------------------------------------------------------------------
# Small operators over the corpus (P1, P3, P5, P6, P8, C11, C14, J-4, L2, U4, S6, S19, G12)
# --------------------------------------------------------------------------
@query
def select_pair(spark, sf_dir):
    return schema.select_pair(V.doc_pairs(spark, sf_dir), "src", "tgt")


@query
def drop_keys(spark, sf_dir):
    return schema.drop_keys(V.table(spark, sf_dir, "documents"), ["text", "n_chars", "absent"])


@query
def ensure_columns(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return schema.ensure_columns(docs, ["lang", "kw_text"], "")


@query
def version_columns(spark, sf_dir):
    """Non-blank texts per version column of the merged corpus."""
    wide = _wide(spark, sf_dir)
    return schema.to_long(wide, align.VERSE_KEY, schema.version_columns(wide)).groupBy("version").agg(
        F.count(F.lit(1)).alias("n_texts"))


@query
def double_prompts(spark, sf_dir):
    return schema.add_prompt(_valid_pairs(spark, sf_dir), "double")


@query
def verse_labels(spark, sf_dir):
    """C11 over the addresses' last path part."""
    pages = V.table(spark, sf_dir, "pages")
    part = F.regexp_extract("url", "://[^/]*(?:/[^/?#]*)*/([^/?#]*)", 1)
    return pages.select("page_id", part.alias("part"), TX.is_verse_label(part).alias("is_label"))


@query
def label_chapters(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    labelled = align.label_chapters(wide, align.chapter_status(wide, V.VERSIONS))
    return schema.non_empty_guard(labelled).select(*align.VERSE_KEY, "status")


@query
def shuffle_order(spark, sf_dir):
    """L2: the documents' place in the operator's reproducible random order."""
    return dedup.with_place(prep.shuffle_order(V.table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]), "rn")


@query
def even_then_odd(spark, sf_dir):
    """U4: the pages' table rows, even ones first."""
    rows = segment.extract_table_pairs(V.table_pages(spark, sf_dir)).where("status = 'ok'")
    return dedup.with_place(joins.even_then_odd(rows, ties=["page_id"]).select("page_id", "cls", "idx", "en"))


@query
def split_status(spark, sf_dir):
    """Requests whose answer lost its last separator."""
    req = _requests(spark, sf_dir)
    cut = F.regexp_replace("request", r"^(.*) <\|\|\|> ", "$1 ")
    answer = F.when(F.col("chunk_id") == 1, cut).otherwise(F.col("request"))
    return req.select("batch_id", "chunk_id", TX.split_status(answer, F.col("n_sentences"))["status"].alias("status"))


@query
def join_spans(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", TX.join_spans(F.split("text", "\n")).alias("joined"))


@query
def complete_batches(spark, sf_dir):
    parsed = _parsed_log(spark, sf_dir)
    return report.complete_batches(parsed, report.batch_errors(parsed)).select("line_no", "batch")
