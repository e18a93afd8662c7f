"""Sources and sinks: write-then-read round trips in a scratch folder."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from parcorpus.operators import report
from parcorpus.sources import manifest, readers, sinks
from tests.conftest import rows

PAIR = "sl string, tl string, pos long"


def _tmp():
    return tempfile.mkdtemp(prefix="parcorpus-test-")


def test_json_with_duplicates(spark):
    d = _tmp()
    df = spark.createDataFrame([("a", "x", 1), ("a ", "x", 2), ("b", "y", 3)], PAIR)
    assert sinks.write_json(df, d, keys=["sl", "tl"], save_duplicates=True) == d
    back = spark.read.json(d)
    assert sorted(rows(back, "part", "pos")) == [("duplicates", 2), ("unique", 1), ("unique", 3)]
    assert sinks.write_json(df.where("false"), _tmp()) is None
    assert sinks.verify_written(spark, d, 3)


def test_read_corpus_json_array_object_and_broken(spark):
    d = _tmp()
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('[{"book_name": "B", "verse": 1, "en_text": "x"}, {"book_name": "B", "verse": 2, "en_text": ""}]')
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('{"book_name": "C", "verse": 1, "en_text": "y"}')
    with open(os.path.join(d, "c.json"), "w") as f:
        f.write('[{"book_name": "D", "verse": ')
    schema = T_.StructType([T_.StructField("book_name", T_.StringType()),
                            T_.StructField("verse", T_.IntegerType()),
                            T_.StructField("en_text", T_.StringType())])
    df = readers.read_corpus_json(spark, d, schema)
    ok = df.where(F.col(readers.CORRUPT).isNull())
    assert sorted(rows(ok, "book_name", "verse")) == [("B", 1), ("B", 2), ("C", 1)]
    assert readers.error_count(df).first()[0] == 1


def test_csv_round_trip(spark):
    d = _tmp()
    df = spark.createDataFrame([("a  b", "[ERROR]", 1), ("a  b", "[ERROR]", 2), ('say "x"', "t", 3)], PAIR)
    sinks.write_csv(df, d, ["sl", "tl", "ol"], dedup_columns=["sl", "tl"], order="pos")
    back = readers.read_corpus_csv(spark, d, ["sl", "tl", "ol", "status"])
    assert sorted(rows(back, "sl", "tl", "status")) == [("a b", "ERROR", "error"), ("say 'x'", "t", "ok")]
    q = _tmp()
    sinks.write_quoted_csv(spark.createDataFrame([('he said "hi"', "t")], "text string, target string"), q)
    assert rows(readers.read_corpus_csv(spark, q, ["text", "target"])) == [('he said "hi"', "t")]


def test_tmx(spark):
    d = _tmp()
    with open(os.path.join(d, "m.tmx"), "w") as f:
        f.write('<tmx><body><tu><tuv xml:lang="br"><seg>Demat</seg></tuv>'
                '<tuv xml:lang="en"><seg>Hello</seg></tuv></tu>'
                '<tu><tuv xml:lang="en"><seg>Only</seg></tuv></tu></body></tmx>')
    got = sorted(rows(readers.read_tmx(spark, d, "br", "en"), "source", "target", "source_language"),
                 key=str)
    assert got == [("Demat", "Hello", "br"), (None, "Only", "br")]


def test_runs_and_previous_run(spark):
    root = _tmp()
    df = spark.createDataFrame([("a", "x", 1)], PAIR)
    sinks.write_run(df, root, dt.datetime(2024, 1, 1, 10, 0, 0))
    sinks.write_run(df.withColumn("pos", F.lit(2).cast("long")), root, dt.datetime(2024, 1, 2, 9, 0, 0))
    sinks.write_run(df.withColumn("pos", F.lit(3).cast("long")), root, dt.datetime(2024, 1, 3, 9, 0, 0))
    prev = readers.read_previous_run(spark, root, "*.json", "second_last")
    assert rows(prev, "run_id", "pos") == [("20240102_090000", 2)]
    last = readers.read_previous_run(spark, root, "*.json", "last", mode="latest")
    assert rows(last, "pos") == [(3,)]
    assert readers.read_previous_run(spark, os.path.join(root, "missing")).count() == 0
    # plain time-stamped run folders with a partial_results subfolder
    base = _tmp()
    for stamp, pos in [("20240101_000000", 1), ("20240102_000000", 2), ("20240103_000000", 3)]:
        d = os.path.join(base, stamp, "partial_results")
        os.makedirs(d)
        with open(os.path.join(d, "Worker_1_Batch_1.json"), "w") as f:
            f.write('{"sl": "a", "pos": %d}\n' % pos)
    prev = readers.read_previous_run(spark, base, "Worker_*.json", subfolder="partial_results")
    assert rows(prev, "run_id", "pos") == [("20240102_000000", 2)]


def test_partials_and_split_outputs(spark):
    root = _tmp()
    df = spark.createDataFrame([("a", "A", 1, 1), ("b", "b", 2, 1), ("c", "[ERROR]", 3, 2), ("d", "D", 4, 2)],
                               "sl string, tl string, pos long, batch_id int")
    sinks.write_partials(df, root, only_complete=True)
    assert sorted(rows(sinks.read_partials(spark, root), "batch_id", "sl")) == [(1, "a")]
    many = spark.range(5000).selectExpr("concat('s', id) sl", "concat('t', id) tl", "id as batch_id")
    wide = _tmp()
    sinks.write_partials(many, wide)
    assert len(manifest.latest(spark, wide)[1]["groups"]) == 5 and sinks.read_partials(spark, wide).count() == 5000
    out = _tmp()
    sinks.split_outputs(df.withColumn("label", F.when(F.col("pos") > 2, "b").otherwise("a")), "label", out)
    assert sorted(n for n in os.listdir(out) if n.startswith("label=")) == ["label=a", "label=b"]


def test_partials_of_a_group_written_in_two_calls(spark):
    root = _tmp()
    kind = "sl string, tl string, batch_id int, at timestamp, score decimal(30,10)"
    at, score = dt.datetime(2024, 5, 1, 12, 30), Decimal("12345678901234567890.0123456789")
    first = [("a", "A", 1, at, score), ("007", "1", 2, None, None), ("c", "[ERROR]", 3, at, None), ("n", "N", None, at, None),
             ("far", "F", 1500, at, score)]
    sinks.write_partials(spark.createDataFrame(first, kind), root, only_complete=True)
    far = manifest.latest(spark, root)[1]["groups"]["batch_group=1"]
    # batch 3 is complete now, batch 2 comes anew, batch 4 has failed
    second = [("c", "C", 3, at, score), ("b", "B", 2, at, None), ("d", "[ERROR]", 4, at, None)]
    sinks.write_partials(spark.createDataFrame(second, kind), root, only_complete=True)
    got = sinks.read_partials(spark, root)
    want = [first[0], second[1], second[0], first[3], first[4]]
    assert sorted(map(repr, rows(got))) == sorted(map(repr, want))
    assert manifest.latest(spark, root)[1]["groups"]["batch_group=1"] == far
    # a column more, and a stored one less; then a call that has nothing to write
    third = spark.createDataFrame([("e", "E", 5, "x")], "sl string, tl string, batch_id int, note string")
    sinks.write_partials(third, root)
    sinks.write_partials(third.limit(0), root)
    names = ["sl", "tl", "batch_id", "at", "score", "note"]
    whole = sorted(map(repr, [*[(*r, None) for r in want], ("e", "E", 5, None, None, "x")]))
    assert sorted(map(repr, rows(sinks.read_partials(spark, root), *names))) == whole
    sinks.drop_replaced(spark, root)
    assert sorted(map(repr, rows(sinks.read_partials(spark, root), *names))) == whole


def test_a_killed_rewrite_of_partials_leaves_the_old_state(spark, monkeypatch):
    root = _tmp()
    kind = "sl string, tl string, batch_id int"
    sinks.write_partials(spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], kind), root)
    before = sorted(rows(sinks.read_partials(spark, root)))
    with monkeypatch.context() as m:
        m.setattr(manifest, "swap", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            sinks.write_partials(spark.createDataFrame([("c", "C", 1)], kind), root)
    assert sorted(rows(sinks.read_partials(spark, root))) == before
    version, state = manifest.latest(spark, root)
    sinks.write_partials(spark.createDataFrame([("d", "D", 2)], kind), root)
    with pytest.raises(FileExistsError):  # a second writer that began from the same state
        manifest.swap(spark, root, version, state)
    assert sorted(rows(sinks.read_partials(spark, root))) == [("a", "A", 1), ("d", "D", 2)]


def test_a_rewrite_of_partials_reads_its_own_groups_only(spark):
    root = _tmp()
    sinks.write_partials(spark.range(3000).selectExpr("concat('s', id) sl", "concat('t', id) tl", "id as batch_id"), root)
    for n, parts in manifest.latest(spark, root)[1]["groups"].items():
        if n != "batch_group=1":  # what is not read cannot harm
            with open(os.path.join(root, parts[0], n, "broken.json"), "w") as f:
                f.write("{no json")
    sinks.write_partials(spark.createDataFrame([("x", "X", 1500)], "sl string, tl string, batch_id long"), root)
    groups = manifest.latest(spark, root)[1]["groups"]
    assert [len(groups[f"batch_group={k}"]) for k in range(3)] == [1, 2, 1]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sinks.read_partials(spark, root).collect()


def test_render_text_files(spark):
    long = spark.createDataFrame([
        ("en", 1, "B", 1, 2, "two", 2), ("en", 1, "B", 1, 1, "one", 1), ("en", 1, "B", 2, 1, "x", 3)],
        "version string, book_id int, book_name string, chapter int, verse int, text string, pos long")
    books = spark.createDataFrame([("Book", 1, 0)], "name string, id int, ordinal int")
    blocks = report.render_text(long, books, {"en": "English"})
    root = _tmp()
    sinks.write_text_blocks(blocks, root, report.RENDER_ORDER)
    vdir = os.path.join(root, "version=en")
    text = "".join(open(os.path.join(vdir, f)).read() for f in sorted(os.listdir(vdir))
                   if f.startswith("part-"))
    assert text == ("The Holy Bible - English\n\nBook\n" + "=" * 50 + "\n\n"
                    "Chapter 1\n" + "-" * 20 + "\n1 one\n2 two\n\n"
                    "Chapter 2\n" + "-" * 20 + "\n1 x\n\n\n")


def test_dims_and_log_filter(spark):
    from parcorpus.sources import dims
    books = dims.book_dim(spark, [{"name": "B2", "id": 7, "chapters": 3}, {"name": "B1", "id": 3}])
    assert rows(books.orderBy("ordinal"), "id", "ordinal") == [(7, 0), (3, 1)]
    assert dims.word_dim(spark, ["save", "x", "save"]).count() == 2
    ts = "2024-01-01 00:00:00"
    lines = spark.createDataFrame([(f"{ts} [INFO] Worker 1 | Batch 1/20 | a",),
                                   (f"{ts} [INFO] Worker 1 | Batch 10/20 | b",)], "value string")
    assert rows(readers.filter_log(lines, 1, 1, 20), "value") == [(f"{ts} [INFO] Worker 1 | Batch 1/20 | a",)]
    root = _tmp()
    readers.split_log_by_batch(readers.parse_log(lines), root)
    assert sorted(n for n in os.listdir(os.path.join(root, "worker=1"))) == ["bucket=1", "bucket=10"]
    assert rows(readers.read_log_batch(spark, root, 1, 10)) == [(f"{ts} [INFO] Worker 1 | Batch 10/20 | b",)]
    odd = readers.parse_log(spark.createDataFrame([("not a log line",), (f"{ts} [WARN] no batch | x",), (None,)], "value string"))
    assert sorted(rows(odd, "ts", "level", "worker", "message"), key=str) == [
        ("", "", None, ""), ("", "", None, ""), (ts, "WARN", None, "no batch | x")]


def test_render_text_hot_chapter_spans_part_files(spark):
    n = 3000
    long = spark.createDataFrame([("en", 1, "B", 1, v, f"t{v}", v) for v in range(1, n + 1)],
                                 "version string, book_id int, book_name string, chapter int, verse int, "
                                 "text string, pos long").repartition(5)
    books = spark.createDataFrame([("Book", 1, 0)], "name string, id int, ordinal int")
    root = _tmp()
    # keep the range partitions apart (AQE would merge them at this size)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        sinks.write_text_blocks(report.render_text(long, books), root, report.RENDER_ORDER)
    finally:
        spark.conf.set(key, old)
    vdir = os.path.join(root, "version=en")
    parts = sorted(f for f in os.listdir(vdir) if f.startswith("part-"))
    assert len(parts) > 1
    text = "".join(open(os.path.join(vdir, f)).read() for f in parts)
    want = ("The Holy Bible - en\n\nBook\n" + "=" * 50 + "\n\nChapter 1\n" + "-" * 20 + "\n"
            + "".join(f"{v} t{v}\n" for v in range(1, n + 1)) + "\n\n")
    assert text == want


def test_render_text_refuses_unknown_book(spark):
    long = spark.createDataFrame([("en", 2, "C", 1, 1, "x", 1)],
                                 "version string, book_id int, book_name string, chapter int, verse int, text string, pos long")
    books = spark.createDataFrame([("Book", 1, 0)], "name string, id int, ordinal int")
    with pytest.raises(Exception, match="no such book: 2"):
        report.render_text(long, books).collect()


def test_previous_run_reads_one_folder(spark):
    base = _tmp()
    for stamp, text in [("20240101_000000", "{bad"), ("20240102_000000", '[{"pos": 2}, {"pos": 3}]'), ("20240103_000000", "{bad")]:
        os.makedirs(os.path.join(base, stamp))
        with open(os.path.join(base, stamp, "Worker_1.json"), "w") as f:
            f.write(text)
    schema = T_.StructType([T_.StructField("pos", T_.LongType()), T_.StructField(readers.CORRUPT, T_.StringType())])
    prev = readers.read_previous_run(spark, base, "Worker_*.json", schema=schema, multi_line=True)
    assert sorted(rows(prev, "pos")) == [(2,), (3,)]
    last = readers.read_previous_run(spark, base, "*.json", "last", schema=schema, multi_line=True)
    assert readers.error_count(last.select("pos", readers.CORRUPT)).first()["error_count"] == 1
    assert readers.read_previous_run(spark, base, "*.csv", schema=schema).count() == 0
