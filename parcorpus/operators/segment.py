"""Segmentation of stored pages and translation-memory blocks.

Every operator works on one page (or one block) at a time with native string
and array expressions, so pages are processed where they are read: no shuffle,
no cross-row order. The verse numbering fold is a Spark ``aggregate`` over the
page's ordered containers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.functions import text as T

TAG_RE = r"<[^>]*>"
# Basic HTML entities decoded in container text (fixed values).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
# Class names of the chapter page and its parts (fixed values).
VERSE_CLASS = "ChapterContent_verse"
LABEL_CLASS = "ChapterContent_label"
CONTENT_CLASS = "ChapterContent_content"
NOTE_CLASS = "ChapterContent_note"
NOT_FOUND_CLASS = "ChapterContent_not-avaliable-span"


def html_text(c: Column) -> Column:
    """Tags removed, basic entities decoded, stripped."""
    s = F.regexp_replace(c, TAG_RE, "")
    for a, b in ENTITIES:
        s = F.replace(s, F.lit(a), F.lit(b))
    return T.strip(s)


def _opening(cls: str) -> str:
    """Pattern of a start tag one of whose classes begins with ``cls``."""
    return f'<[a-zA-Z][a-zA-Z0-9]*[^>]*class="[^"]*{cls}[^"]*"[^>]*>'


def _has(c: Column, cls: str) -> Column:
    """Whether ``c`` has such a tag; the pattern runs only where the class name stands."""
    return c.contains(cls) & c.rlike(_opening(cls))


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def verse_pieces(html: Column, verse: str = VERSE_CLASS) -> Column:
    """A chapter page's text before its first verse container, and from each container's start tag to the next."""
    return F.split(html, _opening(verse))


def verse_containers(pieces: Column, label: str = LABEL_CLASS, content: str = CONTENT_CLASS, note: str = NOTE_CLASS) -> Column:
    """ARRAY<STRUCT<label INT, text STRING, note BOOLEAN>> of the verse containers
    among the :func:`verse_pieces` of a page, in document order. Its label is the
    first label element, if that holds digits only (C11); its text is that of its
    content elements, stripped and joined by a space; ``note`` tells whether it
    has a note element. Parts are ``<span>`` elements and run to their end tag."""
    def one(p):
        first = F.when(p.contains(label), html_text(F.substring_index(
            F.get(F.split(p, _opening(label), 2), F.lit(1)), "</span>", 1)))
        texts = _let(F.split(p, _opening(content)), lambda parts: F.transform(
            F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
            lambda x: html_text(F.substring_index(x, "</span>", 1))))
        return F.struct(
            _let(first, lambda t: F.when(T.is_verse_label(t), t.try_cast("int"))).alias("label"),
            F.array_join(F.array_remove(texts, ""), " ").alias("text"), _has(p, note).alias("note"))

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), one)


#: Containers that one inner fold takes: its array is copied with every piece it gets.
FOLD = 256


def fold_verses(containers: Column) -> Column:
    """T1 fold: containers -> verse texts (1-based list position = verse).

    text + label: if label > len + 1 one "" placeholder is added first, then
    the text; text without label: appended to the last verse with a space (or
    dropped when there is none yet); no text but a note: "" appended; else
    nothing.

    The fold runs over the count of verses and gives each text its place; the
    texts of one place are gathered afterwards. Places are collected by runs of
    ``FOLD`` containers, so that no array of the page's length is copied with
    every container."""
    none = F.array().cast("array<struct<at:int,text:string>>")

    def piece(at, text):
        return F.struct(at.cast("int").alias("at"), text.alias("text"))

    def step(acc, x):
        n = acc["n"]
        has_text = x["text"] != F.lit("")
        labelled = has_text & x["label"].isNotNull()
        gap = labelled & (x["label"] > n + 1)
        bare = ~has_text & x["note"]
        new = (F.when(gap, F.array(piece(n + 1, F.lit("")), piece(n + 2, x["text"])))
               .when(labelled, F.array(piece(n + 1, x["text"])))
               .when(has_text & (n > 0), F.array(piece(n, x["text"])))
               .when(bare, F.array(piece(n + 1, F.lit("")))).otherwise(none))
        return F.struct((n + F.when(gap, 2).when(labelled | bare, 1).otherwise(0)).cast("int").alias("n"),
                        F.concat(acc["out"], new).alias("out"))

    def run(acc, chunk):
        inner = F.aggregate(chunk, F.struct(acc["n"].alias("n"), none.alias("out")), step)
        return _let(inner, lambda i: F.struct(i["n"].alias("n"), F.concat(acc["out"], F.array(i["out"])).alias("out")))

    def placed(c):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / FOLD).cast("int")),
                             lambda k: F.slice(c, k * FOLD + 1, FOLD))
        start = F.struct(F.lit(0).alias("n"), F.array().cast("array<array<struct<at:int,text:string>>>").alias("out"))
        return F.when(F.size(c) == 0, none).otherwise(F.flatten(F.aggregate(chunks, start, run, lambda acc: acc["out"])))

    def gathered(p):
        begins = F.filter(F.sequence(F.lit(0), F.size(p)), lambda i: (i == 0) | (i == F.size(p)) | (
            F.get(p, i)["at"] != F.get(p, i - 1)["at"]))
        verses = _let(begins, lambda b: F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda k: F.array_join(F.transform(
            F.slice(p, F.get(b, k - 1) + 1, F.get(b, k) - F.get(b, k - 1)), lambda x: x["text"]), " ")))
        return F.when(F.size(p) == 0, F.array().cast("array<string>")).otherwise(verses)

    return _let(_let(containers, placed), gathered)


def page_status(html: str = "html", marker: str = NOT_FOUND_CLASS) -> Column:
    """``not_found`` when the page holds the not-available element."""
    return F.when(_has(F.col(html), marker), F.lit("not_found")).otherwise(F.lit("ok"))


def extract_verses(pages: DataFrame, key: str = "page_id", html: str = "html",
                   marker: str = NOT_FOUND_CLASS) -> DataFrame:
    """T1 + T3: one row per verse (key, verse, text) of every available page.

    Each step is a projection over the column of the one before; a page that is
    not available has no pieces, so no filter asks for the page a second time."""
    cut = pages.select(key, F.when(page_status(html, marker) == "ok", verse_pieces(F.col(html))).alias("_p"))
    verses = cut.select(key, verse_containers(F.col("_p")).alias("_c")).select(key, fold_verses(F.col("_c")).alias("_v"))
    return verses.select(key, F.posexplode("_v").alias("_i", "text")).select(
        key, (F.col("_i") + 1).cast("int").alias("verse"), "text")


# A table row of class even or odd, up to its end tag.
ROW_RE = r'(?s)<tr[^>]*class="(?:even|odd)"[^>]*>.*?</tr>'
CELL_RE = r"(?s)</t[dh]>\s*<t[dh][^>]*>"


def extract_table_pairs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """T2 + U4: text pairs of the ``<tr>`` rows of class ``even`` and ``odd``.
    A row's cells are its text split on TAB (S12), quotes made single first,
    both sides stripped. ``out_pos`` numbers the even rows, then the odd ones.
    A row without a second cell has NULL sides and status ``no_pair``; a page
    without rows gives one ``not_found`` row."""
    found = pages.select(key, F.transform(
        F.regexp_extract_all(F.col(html), F.lit(ROW_RE), 0), lambda r, i: F.struct(
            i.alias("idx"), F.when(r.rlike('^<tr[^>]*class="even"'), F.lit("even")).otherwise(F.lit("odd")).alias("cls"),
            r.alias("row"))).alias("_r"))
    rows = found.select(key, F.posexplode_outer(F.concat(
        F.filter("_r", lambda r: r["cls"] == "even"), F.filter("_r", lambda r: r["cls"] == "odd"))).alias("out_pos", "_p"))
    text = html_text(F.regexp_replace("_p.row", CELL_RE, "\t"))
    cells = rows.select(key, "out_pos", "_p", T.split_tab(T.quotes_to_single(text)).alias("_s"))
    return cells.select(
        key, F.col("_p.idx").cast("int").alias("idx"), F.col("_p.cls").alias("cls"),
        F.col("out_pos").cast("int").alias("out_pos"), F.col("_s.first").alias("en"), F.col("_s.second").alias("kw"),
        F.when(F.col("_p").isNull(), F.lit("not_found")).when(F.col("_s.second").isNull(), F.lit("no_pair"))
        .otherwise(F.lit("ok")).alias("status"))


def curate_segments(df: DataFrame, seg: str, excluded: DataFrame, excl_col: str = "text",
                    col: str = "label") -> DataFrame:
    """Segments equal to an excluded sentence are dropped; segments with
    invalid characters are ``corrupted``; the rest ``curated``."""
    kept = df.join(excluded.select(F.col(excl_col).alias(seg)).distinct(), seg, "left_anti")
    return kept.withColumn(col, F.when(T.has_invalid_characters(F.col(seg)), F.lit("corrupted"))
                           .otherwise(F.lit("curated")))


def curate_tmx_blocks(blocks: DataFrame, excluded: DataFrame, block: str = "block",
                      lang: str = "br", excl_col: str = "text", col: str = "label") -> DataFrame:
    """T11 on raw ``<tu>`` blocks: the ``lang`` segment decides; blocks without
    that segment are curated; excluded segments are dropped. A piece that is no
    block (the file's header before the first, its footer after the last) goes
    to both outputs, so that each of them is a whole file."""
    seg = T.tmx_segment(F.col(block), lang)
    with_seg = blocks.withColumn("_seg", seg)
    ex = excluded.select(F.col(excl_col).alias("_seg")).distinct()
    kept = with_seg.join(ex, "_seg", "left_anti")
    lab = F.when(~F.col(block).contains("<tu"), F.array(F.lit("curated"), F.lit("corrupted"))).when(
        F.col("_seg").isNotNull() & T.has_invalid_characters(F.col("_seg")),
        F.array(F.lit("corrupted"))).otherwise(F.array(F.lit("curated")))
    return kept.withColumn(col, F.explode(lab)).drop("_seg")
