"""Scalar text functions (Column -> Column), all native Spark expressions.

Every function here compiles to built-in Catalyst expressions (regexp_replace,
translate, substring, ...), so it stays inside whole-stage codegen. The regular
expressions are written so that the same pattern text runs in Java and in RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Whitespace as Python's str.strip()/str.split()/re "\s" understand it:
# U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028,
# U+2029, U+202F, U+205F, U+3000. Zero-width U+200B-200D and U+FEFF are not
# whitespace.
WS_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
             (0x2000, 0x200A), (0x2028, 0x2028), (0x2029, 0x2029), (0x202F, 0x202F),
             (0x205F, 0x205F), (0x3000, 0x3000)]
WS = "[" + "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}"
                   for a, b in WS_RANGES) + "]"
WS_CHARS = "".join(chr(c) for a, b in WS_RANGES for c in range(a, b + 1))
WS_RUN = WS + "+"
STRIP_RE = "^" + WS_RUN + "|" + WS_RUN + "$"
# ASCII punctuation as in Python's string.punctuation, in its natural order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Quote characters turned into a single quote by clean_text.
QUOTES = "\"“”‘’"
# Invisible characters removed by clean_text (U+2028/2029 are whitespace and
# already became spaces at that point).
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"
# A whole text in brackets; the group is its inside.
BRACKETED_RE = r"(?s)\A\[(.*)\]\z"
# Characters that mark a translation-memory segment as corrupted.
INVALID_CHARS_RE = r"[Æ±\x{0}-\x{8}\x{b}-\x{c}\x{e}-\x{1f}\x{7f}]"
# Separator placed between sentences merged into one translation request.
SENTENCE_SEPARATOR = " <|||> "
SENTENCE_SPLIT_RE = r"<\|\|\|>"
# Characters kept by sanitize_name; everything else becomes "_".
UNSAFE_NAME_RE = r"[^a-zA-Z0-9_\-.]"
# Extension as os.path.splitext finds it: the last dot of the last path
# component that has a non-dot character before it.
EXTENSION_RE = r"(?s)^(?:.*/)?\.*[^/.][^/]*(\.[^/.]*)$"
# Status markers written in place of a translation.
MARKER_ERROR = "[ERROR]"
MARKER_FAILED = "[TRANSLATION FAILED]"
MARKER_NOT_FOUND = "[NOT FOUND]"
MARKER_BACK_PREFIX = "[TRANSLATION BACK FROM "
STATUS_RE = (r"(?s)^\[(ERROR|TRANSLATION FAILED|NOT FOUND|TRANSLATION BACK FROM ([^\]]*))\]"
             r"(?: - | )?(.*)$")
# Code -> English language name (16 entries), unknown codes map to themselves.
LANGUAGE_NAMES = {
    'fr': 'French', 'en': 'English', 'es': 'Spanish', 'de': 'German',
    'it': 'Italian', 'pt': 'Portuguese', 'ru': 'Russian', 'zh': 'Chinese',
    'ja': 'Japanese', 'ko': 'Korean', 'ar': 'Arabic', 'hi': 'Hindi',
    'nl': 'Dutch', 'pl': 'Polish', 'sv': 'Swedish', 'tr': 'Turkish'
}
# Translator hosts; one is chosen per request.
TRANSLATOR_HOSTS = [
    "https://translate.google.com",
    "https://translate.google.ca",
    "https://translate.google.co.uk",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Whitespace and cleaning
# ---------------------------------------------------------------------------
def strip(c) -> Column:
    """Python ``str.strip()``: remove WS at both ends. NULL stays NULL.
    ``btrim`` with the explicit character set: native, no regex."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def ws_to_space(c) -> Column:
    """``re.sub(r"\\s+", " ", s)``: every WS run becomes one space. Done as a
    per-character ``translate`` to spaces plus a plain space squeeze, which is
    cheaper than one regex over the whitespace class."""
    return F.regexp_replace(F.translate(_c(c), WS_CHARS, " " * len(WS_CHARS)), " {2,}", " ")


def split_ws(c) -> Column:
    """``s.split()``: whitespace-separated tokens, empty pieces dropped."""
    spaced = F.translate(_c(c), WS_CHARS, " " * len(WS_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def collapse_ws(c) -> Column:
    """``" ".join(s.split())``: runs of WS become one space, ends trimmed."""
    return strip(ws_to_space(c))


def is_blank(c) -> Column:
    """NULL or nothing but whitespace."""
    return F.coalesce(strip(c) == F.lit(""), F.lit(True))


def clean_text(c, normalize_quotes: bool = True) -> Column:
    """Cleaning applied to every scraped or translated sentence.

    Order: NULL/blank -> ""; WS runs -> one space; quotes -> "'"; zero-width
    characters removed; if the text starts with "[" and ends with "]" both are
    dropped and the inside stripped (one level, checked before the outer strip);
    strip; collapse repeated spaces.
    """
    # characters by one translate, the rest each in one pass over the result of the one before:
    # no part of the expression occurs twice. Runs of spaces are squeezed once, at the end, where
    # a blank text has become "" too
    quotes = QUOTES if normalize_quotes else ""
    s = F.translate(_c(c), WS_CHARS + quotes + ZERO_WIDTH, " " * len(WS_CHARS) + "'" * len(quotes))
    s = F.regexp_replace(s, BRACKETED_RE, "$1")
    return F.coalesce(F.regexp_replace(strip(s), " {2,}", " "), F.lit(""))


def quotes_to_single(c) -> Column:
    """Double quote -> single quote."""
    return F.replace(_c(c), F.lit('"'), F.lit("'"))


def preview_text(c, n: int = 50) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_c(c), 1, n)


def text_length(c) -> Column:
    """Length in code points (Python ``len``)."""
    return F.length(_c(c))


def join_spans(c) -> Column:
    """Output fragments concatenated without separator, then stripped."""
    return strip(F.array_join(_c(c), ""))


# ---------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------
def is_valid_text(c) -> Column:
    """Not NULL, not blank, and the stripped text is not a contiguous piece of
    the ASCII punctuation string (so "!" and "()" are invalid, "..." valid)."""
    s = strip(c)
    ok = (s != F.lit("")) & ~F.lit(PUNCTUATION).contains(s)
    return F.coalesce(ok, F.lit(False))


def is_valid_row(src, tgt) -> Column:
    """Both sides present and not blank (punctuation allowed)."""
    return ~is_blank(src) & ~is_blank(tgt)


def is_degenerate_translation(out, inp, case_insensitive: bool = True) -> Column:
    """Translation output empty, or equal to the input."""
    o, i = _c(out), _c(inp)
    same = (F.lower(o) == F.lower(i)) if case_insensitive else (o == i)
    return is_blank(o) | F.coalesce(same, F.lit(False))


def has_invalid_characters(c) -> Column:
    return F.coalesce(_c(c).rlike(INVALID_CHARS_RE), F.lit(False))


def is_verse_label(c) -> Column:
    """Stripped label made of ASCII digits only."""
    return F.coalesce(strip(c).rlike("^[0-9]+$"), F.lit(False))


def is_failed(tl) -> Column:
    """A translation is failed when it starts with a status marker."""
    return F.coalesce(_c(tl).startswith("["), F.lit(False))


# ---------------------------------------------------------------------------
# Names, sentences, markers, URLs
# ---------------------------------------------------------------------------
def _splitext_ext(s: Column) -> Column:
    return F.regexp_extract(s, EXTENSION_RE, 1)


def sanitize_name(c, max_len: int = 80, remove_ext: bool = True) -> Column:
    """Safe file-name stem: extension dropped, unsafe characters -> "_",
    "_" runs squeezed, ".-_" stripped at the ends, empty -> "unnamed"; longer
    than ``max_len`` keeps an extension of at most 10 characters."""
    x = _c(c)
    if remove_ext:
        ext = _splitext_ext(x)
        x = x.substr(F.lit(1), F.length(x) - F.length(ext))
    s = F.regexp_replace(x, UNSAFE_NAME_RE, "_")
    s = F.regexp_replace(s, "_+", "_")
    s = F.regexp_replace(s, r"^[._\-]+|[._\-]+$", "")
    ext2 = _splitext_ext(s)
    n2 = F.length(s) - F.length(ext2)
    long_ = F.when((F.length(ext2) > 0) & (F.length(ext2) <= 10),
                   F.concat(s.substr(F.lit(1), F.least(n2, F.lit(max_len) - F.length(ext2))), ext2)
                   ).otherwise(F.substring(s, 1, max_len))
    out = F.when(F.length(s) > max_len, long_).otherwise(s)
    return F.when(x.isNull() | (_c(c) == "") | (s == ""), F.lit("unnamed")).otherwise(out)


def merge_sentences(arr) -> Column:
    """Join an array of sentences with the request separator."""
    return F.array_join(_c(arr), SENTENCE_SEPARATOR)


def split_translation(c, expected) -> Column:
    """Split a merged translation; NULL when the part count differs."""
    parts = F.split(_c(c), SENTENCE_SPLIT_RE)
    exp = expected if isinstance(expected, Column) else F.lit(expected)
    return F.when(F.size(parts) == exp, parts)


def split_status(c, expected) -> Column:
    """STRUCT(parts, status) of a merged translation: ``ok`` with its parts, or
    ``split_mismatch`` (``missing`` for NULL) with none."""
    parts = split_translation(c, expected)
    status = F.when(parts.isNotNull(), F.lit("ok")).when(_c(c).isNull(), F.lit("missing")).otherwise(
        F.lit("split_mismatch"))
    return F.struct(parts.alias("parts"), status.alias("status"))


def parse_status(c) -> Column:
    """STRUCT(status, lang, payload) from a translation cell.

    ``[ERROR]`` -> error; ``[TRANSLATION FAILED] - x`` / ``[TRANSLATION FAILED] x``
    -> failed, x; ``[NOT FOUND] - x`` -> not_found, x;
    ``[TRANSLATION BACK FROM l] - x`` -> back, l, x; anything else -> ok, text.
    """
    x = _c(c)
    tag = F.regexp_extract(x, STATUS_RE, 1)
    status = (F.when(x.isNull(), F.lit("missing"))
              .when(tag == "ERROR", F.lit("error"))
              .when(tag == "TRANSLATION FAILED", F.lit("failed"))
              .when(tag == "NOT FOUND", F.lit("not_found"))
              .when(tag.startswith("TRANSLATION BACK FROM"), F.lit("back"))
              .otherwise(F.lit("ok")))
    lang = F.when(status == "back", F.regexp_extract(x, STATUS_RE, 2))
    payload = F.when(status == "ok", x).when(status.isin("error", "missing"), F.lit(None)) \
        .otherwise(F.regexp_extract(x, STATUS_RE, 3))
    return F.struct(status.alias("status"), lang.alias("lang"), payload.alias("payload"))


def url_param(url, key: str) -> Column:
    """First value of a query parameter, %-decoded; NULL if absent or blank."""
    v = F.try_url_decode(F.try_parse_url(_c(url), F.lit("QUERY"), F.lit(key)))
    return F.when(v != "", v)


def url_params(url) -> Column:
    """Query string -> MAP<STRING, ARRAY<STRING>> like ``parse_qs``: pairs
    without "=" or with a blank value dropped, keys and values %-decoded,
    repeated keys keep every value in order."""
    q = F.try_parse_url(_c(url), F.lit("QUERY"))
    pairs = F.filter(F.split(q, "&"), lambda p: F.instr(p, "=") > 1)
    kv = F.transform(pairs, lambda p: F.struct(
        F.try_url_decode(F.substring_index(p, "=", 1)).alias("k"),
        F.try_url_decode(p.substr(F.instr(p, "=") + 1, F.lit(1 << 30))).alias("v")))
    kv = F.filter(kv, lambda x: x["v"] != "")
    keys = F.array_distinct(F.transform(kv, lambda x: x["k"]))
    vals = F.transform(keys, lambda k: F.transform(F.filter(kv, lambda x: x["k"] == k),
                                                   lambda x: x["v"]))
    return F.when(q.isNotNull(), F.map_from_arrays(keys, vals))


def split_tab(c) -> Column:
    """Row text -> STRUCT(first, second) split on TAB, both stripped."""
    parts = F.split(_c(c), "\t")
    ok = F.size(parts) >= 2
    return F.struct(F.when(ok, strip(F.get(parts, 0))).alias("first"),
                    F.when(ok, strip(F.get(parts, 1))).alias("second"))


def language_name(code) -> Column:
    m = F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv])
    return F.coalesce(m[_c(code)], _c(code))


def tmx_segment(block, lang: str) -> Column:
    """Text of ``<tuv xml:lang="L"><seg>...</seg></tuv>`` inside a raw block."""
    pat = r'(?s)<tuv xml:lang="' + lang + r'">\s*<seg>(.*?)</seg>'
    v = F.regexp_extract(_c(block), pat, 1)
    return F.when(_c(block).rlike(pat), v)


def remove_prefix(c, prefix: str) -> Column:
    x = _c(c)
    return F.when(x.startswith(prefix), x.substr(F.lit(len(prefix) + 1), F.length(x))).otherwise(x)


def file_stem(c) -> Column:
    """Path stem: last component without its extension."""
    base = F.regexp_extract(_c(c), r"([^/]*)$", 1)
    ext = _splitext_ext(base)
    return base.substr(F.lit(1), F.length(base) - F.length(ext))


def run_stamp(ts) -> Column:
    """``YYYYmmdd_HHMMSS`` folder stamp."""
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def version_text_key(suffix) -> Column:
    return F.concat(F.lower(_c(suffix)), F.lit("_text"))


def translator_url(sl, tl, key=None) -> Column:
    """Translator page URL for a language pair; the host is picked by a hash of
    ``key`` (deterministic, unlike a random pick)."""
    k = _c(key) if key is not None else F.concat_ws("|", _c(sl), _c(tl))
    hosts = F.array(*[F.lit(h) for h in TRANSLATOR_HOSTS])
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long")
    host = F.get(hosts, F.pmod(h, F.lit(len(TRANSLATOR_HOSTS))).cast("int"))
    return F.format_string("%s/?sl=%s&tl=%s&op=translate", host, _c(sl), _c(tl))


def chapter_url(version_id, abbr, chapter, suffix) -> Column:
    """``https://www.bible.com/bible/{id}/{abbr}.{chapter}.{suffix}``;
    NULL when any part is missing (the row is then rejected by the caller)."""
    parts = [_c(version_id), _c(abbr), _c(chapter), _c(suffix)]
    any_null = parts[0].isNull()
    for p in parts[1:]:
        any_null = any_null | p.isNull()
    return F.when(~any_null, F.format_string("https://www.bible.com/bible/%s/%s.%s.%s", *parts))


def query_param_mismatch(url, sl: str, tl: str) -> Column:
    """The URL's ``sl``/``tl`` query parameters differ from the expected
    language pair (a missing parameter counts as a mismatch)."""
    s = url_param(url, "sl")
    t = url_param(url, "tl")
    return ~(F.coalesce(s == F.lit(sl), F.lit(False)) & F.coalesce(t == F.lit(tl), F.lit(False)))
