"""Scalar text functions on the FIXTURES edge rows."""

from pyspark.sql import functions as F

from parcorpus.functions import text as T


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_is_valid_text(spark):
    vals = ["a", "!", "()", "[\\]", "...", "?!", "   ", None]
    assert one_col(spark, vals, T.is_valid_text) == [True, False, False, False, True, True, False, False]


def test_strip_python_whitespace(spark):
    vals = ["\u00a0x\t", " x\t", "  y \u3000", "\u200bz"]
    assert one_col(spark, vals, T.strip) == ["x", "x", "y", "\u200bz"]


def test_whitespace_class_matches_python(spark):
    # every code point Python strips is stripped, and nothing else in the BMP
    cps = [c for c in range(0x10000) if not (0xD800 <= c <= 0xDFFF)]
    ws = [c for c in cps if chr(c).isspace()]
    df = spark.createDataFrame([(c, "a" + chr(c)) for c in cps], "c int, s string")
    got = {r[0] for r in df.where(T.strip(F.col("s")) == "a").select("c").collect()}
    assert got == set(ws)


def test_clean_text(spark):
    vals = ["  a\t\tb ", "[a b]", " [a]", "“q”", "​", "[a] b [c]", None, "   "]
    assert one_col(spark, vals, T.clean_text) == ["a b", "a b", "[a]", "'q'", "", "a] b [c", "", ""]


def test_sanitize_name(spark):
    vals = ["", "...", "Worker 1 | GEN", "a" * 100, "report.final.txt", "x" * 90 + ".json"]
    out = one_col(spark, vals, T.sanitize_name)
    assert out[:4] == ["unnamed", "unnamed", "Worker_1_GEN", "a" * 80]
    assert out[4] == "report.final"
    assert out[5] == "x" * 80


def test_split_translation(spark):
    df = spark.createDataFrame([("a <|||> b", 2), ("a <|||> b", 3)], "t string, n int")
    got = [r[0] for r in df.select(T.split_translation(F.col("t"), F.col("n"))).collect()]
    assert got == [["a ", " b"], None]


def test_parse_status(spark):
    vals = ["[ERROR]", "[NOT FOUND] - x", "[TRANSLATION BACK FROM en] - x", "x",
            "[TRANSLATION FAILED] - y", "[TRANSLATION FAILED] z"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [tuple(r) for r in df.orderBy("i").select(T.parse_status("v").alias("s"))
           .select("s.status", "s.lang", "s.payload").collect()]
    assert got == [("error", None, None), ("not_found", None, "x"), ("back", "en", "x"),
                   ("ok", None, "x"), ("failed", None, "y"), ("failed", None, "z")]


def test_url_params_and_language(spark):
    df = spark.createDataFrame([("https://h/x?sl=fr&tl=en&tl=br&e=&op=translate",)], "u string")
    r = df.select(T.url_params("u").alias("m"), T.url_param("u", "sl").alias("sl"),
                  T.language_name(F.lit("fr")).alias("n"), T.language_name(F.lit("xx")).alias("x")).first()
    assert r["m"] == {"sl": ["fr"], "tl": ["en", "br"], "op": ["translate"]}
    assert (r["sl"], r["n"], r["x"]) == ("fr", "French", "xx")


def test_small_helpers(spark):
    df = spark.createDataFrame([("a\tb ",)], "s string")
    r = df.select(T.split_tab("s").alias("p"), T.quotes_to_single(F.lit('say "hi"')).alias("q"),
                  T.has_invalid_characters(F.lit("ok\x01")).alias("bad"),
                  T.is_verse_label(F.lit(" 12 ")).alias("lab"),
                  T.is_failed(F.lit("[ERROR]")).alias("f"),
                  T.remove_prefix(F.lit("out/file.json"), "out/").alias("rp"),
                  T.file_stem(F.lit("/a/b/name.tar.gz")).alias("stem"),
                  T.join_spans(F.array(F.lit(" a"), F.lit("b "))).alias("js")).first()
    assert (r["p"]["first"], r["p"]["second"]) == ("a", "b")
    assert r["q"] == "say 'hi'" and r["bad"] and r["lab"] and r["f"]
    assert (r["rp"], r["stem"], r["js"]) == ("file.json", "name.tar", "ab")


def test_query_param_mismatch(spark):
    df = spark.createDataFrame([("https://h/?sl=fr&tl=en&op=translate",), ("https://h/?sl=de&tl=en",),
                                ("https://h/",)], "u string")
    got = [r[0] for r in df.select(T.query_param_mismatch("u", "fr", "en")).collect()]
    assert got == [False, True, True]
