"""Text functions against plain-Python statements of the same rules, over
random strings built from the characters that matter (Python whitespace,
zero-width characters, quotes, brackets, dots, slashes, letters)."""

import os
import random
import re

from pyspark.sql import functions as F

from parcorpus.functions import text as T

ALPHABET = (list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0        　")
            + ["​", "‌", "‍", "﻿"] + list("\"“”‘’'[]()!?.-_/") + list("abcXYZ09é"))


def py_clean(t):
    if not isinstance(t, str) or not t.strip():
        return ""
    t = re.sub(r"\s+", " ", t)
    for q in "\"“”‘’":
        t = t.replace(q, "'")
    t = re.sub("[​‌‍﻿  ]", "", t)
    if t and t[0] == "[" and t[-1] == "]":
        t = t[1:-1].strip()
    return re.sub(" +", " ", t.strip())


def py_sanitize(t, max_len=80):
    if not t:
        return "unnamed"
    t = os.path.splitext(t)[0]
    s = re.sub(r"[^a-zA-Z0-9_\-\.]", "_", t)
    s = re.sub(r"_+", "_", s).strip(".-_")
    if not s:
        return "unnamed"
    if len(s) > max_len:
        name, ext = os.path.splitext(s)
        if 0 < len(ext) <= 10:
            return name[:max_len - len(ext)] + ext
        return s[:max_len]
    return s


def _random_strings(seed, n, max_len):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len)))) for _ in range(n)]


def _run(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_text_matches_python(spark):
    vals = _random_strings(1, 3000, 12)
    assert _run(spark, vals, T.clean_text) == [py_clean(v) for v in vals]


def test_strip_and_collapse_match_python(spark):
    vals = _random_strings(2, 3000, 12)
    assert _run(spark, vals, T.strip) == [v.strip() for v in vals]
    assert _run(spark, vals, T.collapse_ws) == [" ".join(v.split()) for v in vals]


def test_sanitize_name_matches_python(spark):
    rnd = random.Random(3)
    pieces = ["a", "B", "9", ".", "..", "_", "-", "/", " ", "é", "|", "txt", "json"]
    vals = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    vals += ["x" * rnd.randint(70, 100) + rnd.choice(["", ".json", ".verylongextension", "."])
             for _ in range(300)]
    assert _run(spark, vals, T.sanitize_name) == [py_sanitize(v) for v in vals]


def test_is_valid_text_matches_python(spark):
    import string
    vals = _random_strings(4, 3000, 4)

    def ok(t):
        return bool(t) and t.strip() != "" and t.strip() not in string.punctuation

    assert _run(spark, vals, T.is_valid_text) == [ok(v) for v in vals]


def test_url_params_match_parse_qs(spark):
    from urllib.parse import parse_qs, urlparse
    rnd = random.Random(5)
    keys = ["sl", "tl", "op", "q", "a%20b", "x"]
    vals = ["fr", "en", "", "a+b", "%C3%A9t%C3%A9", "translate", "1"]
    urls = []
    for _ in range(500):
        pairs = [f"{rnd.choice(keys)}={rnd.choice(vals)}" if rnd.random() < 0.9 else rnd.choice(keys)
                 for _ in range(rnd.randint(0, 5))]
        urls.append("https://h.example.com/p?" + "&".join(pairs) if pairs else "https://h.example.com/p")
    got = _run(spark, urls, T.url_params)
    want = [parse_qs(urlparse(u).query) if urlparse(u).query else None for u in urls]
    assert [dict(g) if g is not None else None for g in got] == \
        [w if w is not None else None for w in want]


def test_split_ws_matches_python(spark):
    vals = _random_strings(6, 2000, 14)
    assert _run(spark, vals, T.split_ws) == [v.split() for v in vals]
