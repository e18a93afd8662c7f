"""Page segmentation: the verse fold against a plain Python loop."""

import random
import time

from pyspark.sql import functions as F

from parcorpus.operators import segment
from tests.conftest import rows

CONT = "array<struct<label:int,text:string,note:boolean>>"


def python_fold(containers):
    verses = []
    for label, text, note in containers:
        if text and label is not None:
            if label > len(verses) + 1:
                verses.append("")
            verses.append(text)
        elif text:
            if verses:
                verses[-1] = verses[-1] + " " + text
        elif note:
            verses.append("")
    return verses


def test_fold_fixture(spark):
    cont = [(1, "a", False), (None, "b", False), (4, "c", False), (None, "", True)]
    df = spark.createDataFrame([(cont,)], f"c {CONT}")
    assert df.select(segment.fold_verses(F.col("c"))).first()[0] == ["a b", "", "c", ""]
    assert python_fold(cont) == ["a b", "", "c", ""]


def test_fold_matches_loop(spark):
    rnd = random.Random(3)
    pages = []
    for pid in range(300):
        cont = []
        for _ in range(rnd.randint(0, 12)):
            label = rnd.choice([None, rnd.randint(1, 15)])
            text = rnd.choice(["", "x", "y z", "w"])
            cont.append((label, text, rnd.random() < 0.3))
        pages.append((pid, cont))
    df = spark.createDataFrame(pages, f"pid int, c {CONT}")
    got = dict(rows(df.select("pid", segment.fold_verses(F.col("c")))))
    assert got == {pid: python_fold(c) for pid, c in pages}


def test_fold_of_a_very_long_page(spark):
    rnd = random.Random(4)
    cont = [(rnd.choice([None, k, k + 3, 10 * k]), rnd.choice(["", "x", "y z"]), rnd.random() < 0.3) for k in range(50_000)]
    df = spark.createDataFrame([(cont,), ([],)], f"c {CONT}")
    begun = time.time()
    got = [list(r[0]) for r in df.select(segment.fold_verses(F.col("c"))).collect()]
    assert got == [python_fold(cont), []] and time.time() - begun < 60


def verse(*parts):
    return '<div class="ChapterContent_verse__a1">' + "".join(
        f'<span class="ChapterContent_{k}__b2">{v}</span>' for k, v in parts) + "</div>"


def test_extract_verses_from_markup(spark):
    html = "<html><p>x</p>" + "".join([
        verse(("label", "1"), ("content", "One ")), verse(("label", "#"), ("content", "two"), ("content", " <b>&amp;</b> three")),
        verse(("content", "more")), verse(("label", " 5 "), ("content", "Five")), verse(("label", "6"), ("content", " "), ("note", "n")),
        verse(("label", "7"), ("content", "")), verse(("label", "7"), ("content", "Seven"), ("note", "n"))])
    gone = verse(("label", "1"), ("content", "x")) + '<span class="ChapterContent_not-avaliable-span__q">no</span>'
    pages = spark.createDataFrame([(1, html), (2, gone), (3, "<p>none</p>"), (4, None)], "page_id int, html string")
    got = rows(segment.extract_verses(pages).orderBy("verse"), "page_id", "verse", "text")
    assert got == [(1, 1, "One two & three more"), (1, 2, ""), (1, 3, "Five"), (1, 4, ""), (1, 5, ""), (1, 6, "Seven")]
    status = dict(rows(pages.select("page_id", segment.page_status().alias("s"))))
    assert status == {1: "ok", 2: "not_found", 3: "ok", 4: "ok"}


def test_extract_table_pairs(spark):
    html = ('<table><tr class="odd"><td>a0</td><td>b0</td></tr>\n<tr class="even"><td>a1</td>\n <td>b "1"</td></tr>'
            '<tr class="odd"><td> a2 </td><td><i>b2</i></td></tr><tr class="head"><td>h</td><td>h</td></tr>'
            '<tr class="even"><td>alone</td></tr></table>')
    pages = spark.createDataFrame([(1, html), (2, "<ul><li><a href='x'>y</a></li></ul>")], "page_id int, html string")
    got = rows(segment.extract_table_pairs(pages).orderBy("page_id", "out_pos"),
               "page_id", "idx", "cls", "out_pos", "en", "kw", "status")
    assert got == [(1, 1, "even", 0, "a1", "b '1'", "ok"), (1, 3, "even", 1, None, None, "no_pair"),
                   (1, 0, "odd", 2, "a0", "b0", "ok"), (1, 2, "odd", 3, "a2", "b2", "ok"),
                   (2, None, None, None, None, None, "not_found")]


def test_curate_tmx_blocks(spark):
    blocks = spark.createDataFrame([
        ('<tu><tuv xml:lang="br"><seg>mat</seg></tuv></tu>',),
        ('<tu><tuv xml:lang="br"><seg>fall±</seg></tuv></tu>',),
        ('<tu><tuv xml:lang="br"><seg>skip me</seg></tuv></tu>',),
        ('<tu><tuv xml:lang="en"><seg>no breton</seg></tuv></tu>',)], "block string")
    excl = spark.createDataFrame([("skip me",)], "text string")
    got = sorted(rows(segment.curate_tmx_blocks(blocks, excl), "label"))
    assert got == [("corrupted",), ("curated",), ("curated",)]
    ends = spark.createDataFrame([("<tmx><body>",), ("</body></tmx>",)], "block string")
    assert sorted(rows(segment.curate_tmx_blocks(ends, excl))) == [
        ("</body></tmx>", "corrupted"), ("</body></tmx>", "curated"), ("<tmx><body>", "corrupted"), ("<tmx><body>", "curated")]
