"""DuckDB SQL twins of the registered queries (the correctness oracle).

The rules are stated here once more, in SQL, and where the library has a pattern
by string and list functions, so that a rule that goes wrong in the library does
not match its twin.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Fixed values (must equal the reference's behaviour)
WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_RUN = WS + "+"
STRIP_RE = f"^{WS_RUN}|{WS_RUN}$"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
QUOTES = "\"“”‘’"
ZERO_WIDTH = (0x200B, 0x200C, 0x200D, 0xFEFF)
INVALID_CHARS = "Æ±"
SAFE_NAME_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-."
STATUS_RE = r"(?s)^\[(ERROR|TRANSLATION FAILED|NOT FOUND|TRANSLATION BACK FROM ([^\]]*))\](?: - | )?(.*)$"
LOG_RE = r"^(\S+ \S+) \[([A-Z]+)\] (?:Worker ([0-9]+) \| Batch ([0-9]+)/([0-9]+) \| )?(.*)$"
VERSIONS = ("en", "fr", "de", "es")
LANGUAGES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
HOSTS = ("https://translate.google.com", "https://translate.google.ca", "https://translate.google.co.uk")
LINES_PER_BATCH, WORKERS, LENGTH_FACTOR = 30, 14, 1.37


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {_q(STRIP_RE)}, '', 'g')"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, {_q(WS_RUN)}, ' ', 'g')")


def is_blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', TRUE)"


def clean_text(x: str) -> str:
    s = f"regexp_replace({x}, {_q(WS_RUN)}, ' ', 'g')"
    s = f"translate({s}, {_q(QUOTES)}, {_q(chr(39) * len(QUOTES))})"
    for code in ZERO_WIDTH:
        s = f"replace({s}, chr({code}), '')"
    inner = strip(f"substr({s}, 2, length({s}) - 2)")
    s = f"(CASE WHEN starts_with({s}, '[') AND ends_with({s}, ']') THEN {inner} ELSE {s} END)"
    s = f"regexp_replace({strip(s)}, ' +', ' ', 'g')"
    return f"CASE WHEN {is_blank(x)} THEN '' ELSE {s} END"


def has_invalid_characters(x: str) -> str:
    """Æ, ± or a control character other than tab, line feed and carriage return."""
    return (f"(len(list_filter(string_split({x}, ''), lambda c: contains({_q(INVALID_CHARS)}, c) "
            "OR unicode(c) < 32 AND unicode(c) NOT IN (9, 10, 13) OR unicode(c) = 127)) > 0)")


def extension(x: str) -> str:
    """From the last dot of the last part of a path on, if it has one behind its leading dots."""
    return (f"(CASE WHEN contains(ltrim(string_split({x}, '/')[-1], '.'), '.') "
            f"THEN '.' || string_split({x}, '.')[-1] ELSE '' END)")


def is_valid_text(x: str) -> str:
    s = strip(x)
    return f"coalesce({s} <> '' AND NOT contains({_q(PUNCTUATION)}, {s}), FALSE)"


BOOK_ID = "CAST(('0x' || substr(md5(source), 1, 15)) AS BIGINT)"
VERSES_LONG = f"""verses_long AS (
  SELECT version, book_id, book_name, chapter, CAST(i AS INTEGER) AS verse, parts[i] AS text,
         doc_id, (doc_id, i) AS pos
  FROM (SELECT lang AS version, {BOOK_ID} AS book_id, source AS book_name, CAST(doc_id // 100 AS INTEGER) AS chapter, doc_id,
               string_split(text, chr(10)) AS parts,
               unnest(generate_series(1, len(string_split(text, chr(10))))) AS i
        FROM documents))"""


def _merged_cte() -> str:
    cols = ",\n    ".join(
        f"coalesce(arg_max(text, pos) FILTER (WHERE version = '{v}' AND text <> ''), '') AS {v}_text"
        for v in VERSIONS)
    return f"""merged AS (
  SELECT book_name, arg_min(book_id, pos) AS book_id, chapter, verse,
    {cols}
  FROM verses_long GROUP BY book_name, chapter, verse)"""


def _present_cte() -> str:
    parts = "\n    UNION ALL ".join(
        f"SELECT book_name, chapter, verse, '{v}' AS version, {strip(v + '_text')} AS text, "
        f"{i} AS ordinal FROM merged" for i, v in enumerate(VERSIONS))
    return f"""present AS (
  SELECT * FROM ({parts}) WHERE text <> '')"""


COUNTS = """counts AS (
  SELECT book_name, chapter, version, count(*) AS n, min(verse) AS first_verse,
         min(ordinal) AS ordinal
  FROM present GROUP BY book_name, chapter, version)"""

MAJORITY = """freq AS (
  SELECT book_name, chapter, n, count(*) AS freq, min((first_verse, ordinal)) AS first_key
  FROM counts GROUP BY book_name, chapter, n),
chap AS (
  SELECT book_name, chapter, count(*) AS n_distinct,
         first(n ORDER BY freq DESC, first_key) AS majority
  FROM freq GROUP BY book_name, chapter),
mo AS (
  SELECT c.book_name, c.chapter, any_value(h.majority) AS majority,
         string_agg(c.version || ':' || CAST(c.n AS VARCHAR), ','
                    ORDER BY c.n, c.first_verse, c.ordinal) AS counts,
         coalesce(string_agg(CASE WHEN c.n <> h.majority THEN c.version END, ','
                    ORDER BY c.first_verse, c.ordinal), '') AS outliers,
         list(CASE WHEN c.n <> h.majority THEN c.version END) AS outlier_list
  FROM counts c JOIN chap h USING (book_name, chapter)
  WHERE h.n_distinct > 1
  GROUP BY c.book_name, c.chapter)"""

STATS = """stats AS (
  SELECT book_name, chapter, verse, count(*) AS n_versions, avg(length(text)) AS mean_len
  FROM present GROUP BY book_name, chapter, verse HAVING count(*) >= 2)"""

SUSPICIOUS = f"""plen AS (SELECT *, length(text) AS len FROM present),
cand AS (
  SELECT p.book_name, p.chapter, p.verse, p.version, p.ordinal
  FROM plen p JOIN stats s USING (book_name, chapter, verse)
       JOIN mo m USING (book_name, chapter)
  WHERE list_contains(m.outlier_list, p.version) AND p.len > s.mean_len * {LENGTH_FACTOR}::DOUBLE),
split AS (SELECT book_name, chapter, min(verse) AS split_verse FROM cand GROUP BY book_name, chapter),
sv AS (
  SELECT p.book_name, p.chapter, any_value(sp.split_verse) AS split_verse,
    coalesce(string_agg(CASE WHEN list_contains(m.outlier_list, p.version)
                              AND p.len > s.mean_len * {LENGTH_FACTOR}::DOUBLE THEN p.version END, ','
                        ORDER BY p.ordinal), '') AS suspects,
    string_agg(p.version || ':' || CAST(p.len AS VARCHAR), ',' ORDER BY p.ordinal) AS lengths
  FROM plen p JOIN split sp ON p.book_name = sp.book_name AND p.chapter = sp.chapter
                            AND p.verse = sp.split_verse
       JOIN mo m ON p.book_name = m.book_name AND p.chapter = m.chapter
       JOIN stats s ON p.book_name = s.book_name AND p.chapter = s.chapter AND p.verse = s.verse
  GROUP BY p.book_name, p.chapter)"""

STATUS = """chapters AS (SELECT book_name, chapter, count(*) AS n_rows FROM merged GROUP BY 1, 2),
per_chapter AS (
  SELECT book_name, chapter, count(DISTINCT n) AS n_distinct, count(*) AS n_versions
  FROM counts GROUP BY 1, 2),
status AS (
  SELECT c.book_name, c.chapter, c.n_rows, coalesce(p.n_versions, 0) AS n_versions,
         CASE WHEN p.n_distinct IS NULL THEN 'empty' WHEN p.n_distinct = 1 THEN 'consistent'
              ELSE 'inconsistent' END AS status
  FROM chapters c LEFT JOIN per_chapter p USING (book_name, chapter))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ALIGN_BASE = (VERSES_LONG, _merged_cte())
ALIGN_FULL = ALIGN_BASE + (_present_cte(), COUNTS)

ORACLE["merge_versions"] = _with(*ALIGN_BASE) + "SELECT * FROM merged"

ORACLE["merge_stats"] = _with(*ALIGN_BASE) + f"""SELECT
  (SELECT count(*) FROM verses_long) AS total_entries,
  count(*) AS unique_verses, count(*) AS merged_rows,
  count(*) FILTER (WHERE {' OR '.join(f"{v}_text = ''" for v in VERSIONS)}) AS incomplete_rows
FROM merged"""

ORACLE["verse_counts"] = _with(*ALIGN_FULL) + "SELECT book_name, chapter, version, n FROM counts"

ORACLE["chapter_consistency"] = _with(*ALIGN_FULL, STATUS) + "SELECT * FROM status"

ORACLE["majority_outliers"] = _with(*ALIGN_FULL, MAJORITY) + \
    "SELECT book_name, chapter, majority, counts, outliers FROM mo"

ORACLE["verse_length_stats"] = _with(*ALIGN_FULL, STATS) + \
    "SELECT book_name, chapter, verse, n_versions, round(mean_len, 6) AS mean_len FROM stats"

ORACLE["first_suspicious_verse"] = _with(*ALIGN_FULL, MAJORITY, STATS, SUSPICIOUS) + \
    "SELECT book_name, chapter, split_verse, suspects, lengths FROM sv"

ORACLE["salvage"] = _with(*ALIGN_FULL, MAJORITY, STATS, SUSPICIOUS, STATUS) + """SELECT
  w.book_name, w.chapter, w.verse,
  CASE WHEN sp.split_verse IS NULL OR w.verse < sp.split_verse THEN 'good' ELSE 'suspect' END AS label
FROM merged w JOIN status st USING (book_name, chapter)
LEFT JOIN split sp USING (book_name, chapter)
WHERE st.status <> 'empty'"""

ORACLE["alignment_report"] = _with(*ALIGN_FULL, MAJORITY, STATS, SUSPICIOUS) + """,
sides AS (
  SELECT w.book_name, w.chapter, count(*) FILTER (WHERE w.verse < s.split_verse) AS n_good,
         count(*) FILTER (WHERE w.verse >= s.split_verse) AS n_suspect
  FROM merged w JOIN sv s USING (book_name, chapter) GROUP BY 1, 2)
SELECT m.book_name, m.chapter, m.majority, s.split_verse, d.n_good, d.n_suspect,
       m.counts, m.outliers, s.suspects
FROM mo m LEFT JOIN sv s USING (book_name, chapter) LEFT JOIN sides d USING (book_name, chapter)"""

BOOKS = f"""books AS (SELECT DISTINCT source AS name, {BOOK_ID} AS id,
  coalesce(TRY_CAST(regexp_extract(source, '[0-9]+', 0) AS INTEGER), 2147483647) AS ordinal FROM documents)"""

ORACLE["canonical_order"] = _with(*ALIGN_BASE) + """, """ + BOOKS + """
SELECT coalesce(b.ordinal, -1) AS book_ord, m.book_name, m.chapter, m.verse, m.en_text,
  row_number() OVER (ORDER BY coalesce(b.ordinal, -1), m.chapter, m.verse) AS place
FROM merged m LEFT JOIN books b ON m.book_id = b.id"""


# --------------------------------------------------------------------------
# De-duplication / translations / logs
# --------------------------------------------------------------------------
DOC_PAIRS = """doc_pairs AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, lang, l[i] AS src, l[1 + i % len(l)] AS tgt, (doc_id, i) AS pos
  FROM (SELECT *, unnest(generate_series(1, len(l))) AS i
        FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents)))"""

TRANSLATIONS = DOC_PAIRS + """,
translations AS (
  SELECT doc_id, line, src AS sl,
         CASE (doc_id + line) % 10 WHEN 0 THEN '[ERROR]' WHEN 1 THEN src
              WHEN 2 THEN '[TRANSLATION FAILED] - ' || src
              WHEN 3 THEN '[TRANSLATION BACK FROM en] - ' || src ELSE tgt END AS tl,
         tgt AS ol, pos
  FROM doc_pairs)"""

PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS en, a.text AS target, (u.conv_id, u.turn) AS pos
  FROM conversations u JOIN conversations a
    ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""

CLEAN = """cleaned AS (
  SELECT * FROM translations
  WHERE coalesce(sl, '') <> coalesce(tl, '') AND NOT contains(coalesce(sl, ''), '[ERROR]')
    AND NOT contains(coalesce(tl, ''), '[ERROR]')
  QUALIFY row_number() OVER (PARTITION BY coalesce(sl, ''), coalesce(tl, '') ORDER BY pos) = 1)"""


def _first_label(table: str, a: str, b: str, order: str = "pos", do_strip: bool = True) -> str:
    ka = strip(f"coalesce({a}, '')") if do_strip else f"coalesce({a}, '')"
    kb = strip(f"coalesce({b}, '')") if do_strip else f"coalesce({b}, '')"
    return (f"SELECT *, {order} > min({order}) OVER (PARTITION BY {ka}, {kb}) AS is_duplicate "
            f"FROM {table}")


ORACLE["split_duplicates"] = _with(DOC_PAIRS) + \
    f"SELECT doc_id, line, is_duplicate FROM ({_first_label('doc_pairs', 'src', 'tgt')})"

ORACLE["cross_seen_duplicates"] = _with(DOC_PAIRS) + f"""SELECT doc_id, line,
  pos > min(pos) OVER (PARTITION BY {strip("coalesce(src, '')")})
  AND pos > min(pos) OVER (PARTITION BY {strip("coalesce(tgt, '')")}) AS is_duplicate
FROM doc_pairs"""

ORACLE["mark_all_duplicates"] = _with(DOC_PAIRS) + """SELECT doc_id, line,
  count(*) OVER (PARTITION BY src, tgt) > 1 AS is_duplicate FROM doc_pairs"""

ORACLE["keep_first"] = _with(DOC_PAIRS) + """SELECT doc_id, line, src, tgt FROM doc_pairs
QUALIFY row_number() OVER (PARTITION BY coalesce(src, ''), coalesce(tgt, '') ORDER BY pos) = 1"""

ORACLE["dedup_stats"] = _with(DOC_PAIRS) + f"""SELECT count(*) AS total,
  count(*) FILTER (WHERE NOT is_duplicate) AS "unique",
  count(*) FILTER (WHERE is_duplicate) AS duplicates
FROM ({_first_label('doc_pairs', 'src', 'tgt')})"""

ORACLE["clean_corpus"] = _with(TRANSLATIONS, CLEAN) + "SELECT doc_id, line, sl, tl, ol FROM cleaned"

ORACLE["drop_untranslated"] = _with(TRANSLATIONS) + \
    "SELECT doc_id, line, sl, tl FROM translations WHERE tl IS DISTINCT FROM sl"

_STATUS_RE = _q(STATUS_RE)
ORACLE["translation_status"] = _with(TRANSLATIONS) + f"""SELECT doc_id, line, status,
  CASE WHEN status = 'back' THEN regexp_extract(tl, {_STATUS_RE}, 2) END AS lang,
  CASE WHEN status = 'ok' THEN tl WHEN status IN ('error', 'missing') THEN NULL
       ELSE regexp_extract(tl, {_STATUS_RE}, 3) END AS payload
FROM (SELECT *, CASE WHEN tl IS NULL THEN 'missing'
    WHEN regexp_extract(tl, {_STATUS_RE}, 1) = 'ERROR' THEN 'error'
    WHEN regexp_extract(tl, {_STATUS_RE}, 1) = 'TRANSLATION FAILED' THEN 'failed'
    WHEN regexp_extract(tl, {_STATUS_RE}, 1) = 'NOT FOUND' THEN 'not_found'
    WHEN starts_with(regexp_extract(tl, {_STATUS_RE}, 1), 'TRANSLATION BACK FROM') THEN 'back'
    ELSE 'ok' END AS status FROM translations)"""

ORACLE["translation_stats"] = _with(TRANSLATIONS) + """SELECT count(*) AS total,
  count(*) FILTER (WHERE NOT coalesce(starts_with(tl, '['), FALSE)) AS successful,
  count(*) FILTER (WHERE coalesce(starts_with(tl, '['), FALSE)) AS failed,
  CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE NOT coalesce(starts_with(tl, '['), FALSE)) / count(*), 1) END AS pct_successful,
  CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE coalesce(starts_with(tl, '['), FALSE)) / count(*), 1) END AS pct_failed
FROM translations"""

ORACLE["failure_report"] = _with(TRANSLATIONS) + """SELECT idx, printf('#%04d', idx) AS label,
  sl, coalesce(ol, 'N/A') AS ol, tl
FROM (SELECT *, row_number() OVER (ORDER BY pos) AS idx FROM translations)
WHERE coalesce(starts_with(tl, '['), FALSE)"""

ORACLE["minus_existing"] = _with(TRANSLATIONS, CLEAN) + """SELECT doc_id, line, src AS sl, tgt AS ol
FROM doc_pairs d WHERE NOT EXISTS (SELECT 1 FROM cleaned c
  WHERE c.sl IS NOT DISTINCT FROM d.src AND c.ol IS NOT DISTINCT FROM d.tgt)"""

ORACLE["append_corpus"] = _with(TRANSLATIONS, CLEAN) + f""", u AS (
  SELECT doc_id, line, 0 AS gen, src AS sl, tgt AS tl, pos FROM doc_pairs
  UNION ALL SELECT doc_id, line, 1 AS gen, sl, tl, pos FROM cleaned)
SELECT doc_id, line, gen, sl, tl,
  (gen, pos) > min((gen, pos)) OVER (PARTITION BY {strip("coalesce(sl, '')")}, {strip("coalesce(tl, '')")}) AS is_duplicate
FROM u"""

ORACLE["read_many"] = _with(DOC_PAIRS, PAIRS) + f""", u AS (
  SELECT 0 AS dataset, src, tgt FROM doc_pairs
  UNION ALL SELECT 1 AS dataset, en AS src, target AS tgt FROM pairs)
SELECT DISTINCT dataset, src, tgt FROM u
WHERE NOT {is_blank('src')} AND NOT {is_blank('tgt')}"""

def _log_cte() -> str:
    r = _q(LOG_RE)
    return f"""log_lines AS (
  SELECT event_id AS line_no,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [' || upper(event_type) || '] Worker ' ||
    CAST(user_id % {WORKERS} AS VARCHAR) || ' | Batch ' || CAST(event_id // {LINES_PER_BATCH} AS VARCHAR)
    || '/' || CAST((SELECT max(event_id) // {LINES_PER_BATCH} + 1 FROM events) AS VARCHAR) || ' | ' || props AS value
  FROM events),
parsed AS (
  SELECT line_no, value, regexp_extract(value, {r}, 1) AS ts, regexp_extract(value, {r}, 2) AS level,
    TRY_CAST(regexp_extract(value, {r}, 3) AS INTEGER) AS worker,
    TRY_CAST(regexp_extract(value, {r}, 4) AS INTEGER) AS batch,
    TRY_CAST(regexp_extract(value, {r}, 5) AS INTEGER) AS total,
    regexp_extract(value, {r}, 6) AS message
  FROM log_lines)"""


ORACLE["log_by_batch"] = _with(_log_cte()) + """SELECT worker, batch, total, count(*) AS n_lines,
  min(ts) AS first_ts FROM parsed GROUP BY worker, batch, total"""

ORACLE["batch_errors"] = _with(_log_cte()) + """SELECT batch, count(*) AS n_rows,
  count(*) FILTER (WHERE level = 'ERROR') AS n_errors,
  count(*) FILTER (WHERE level = 'ERROR') = 0 AS complete
FROM parsed GROUP BY batch"""

ORACLE["log_kept_ratio"] = _with(_log_cte()) + """SELECT worker, batch, count(*) AS kept,
  (SELECT count(*) FROM parsed) AS total,
  round(100.0 * count(*) / (SELECT count(*) FROM parsed), 1) AS pct_kept
FROM parsed WHERE batch IS NOT NULL GROUP BY worker, batch"""

ORACLE["filter_log"] = _with(_log_cte()) + """SELECT worker, batch, line_no, value FROM parsed
WHERE batch IS NOT NULL"""
ORACLE["log_batch_lines"] = _with(_log_cte()) + """SELECT value FROM parsed
WHERE worker = 1 AND batch = (SELECT min(batch) FROM parsed WHERE worker = 1)"""


# --------------------------------------------------------------------------
# Training-set preparation and BLEU
# --------------------------------------------------------------------------
VALID_PAIRS = """valid_pairs AS (
  SELECT * FROM (
    SELECT en_text AS en, fr_text AS target, 'fr' AS language FROM merged
    UNION ALL SELECT en_text, de_text, 'de' FROM merged
    UNION ALL SELECT en_text, es_text, 'es' FROM merged)
  WHERE {v_en} AND {v_tg})""".format(v_en=is_valid_text("en"), v_tg=is_valid_text("target"))

PAIRS_BASE = (VERSES_LONG, _merged_cte(), VALID_PAIRS)

ORACLE["valid_pairs"] = _with(*PAIRS_BASE) + "SELECT en, target, language FROM valid_pairs"
ORACLE["pair_counts"] = _with(*PAIRS_BASE) + \
    "SELECT language, count(*) AS n_pairs FROM valid_pairs GROUP BY language"
ORACLE["training_prompts"] = _with(*PAIRS_BASE) + f"""SELECT en, target, language,
  'translate English to ' || language || ': ' || {strip('en')} AS prompt FROM valid_pairs"""
ORACLE["hash_split"] = _with(*PAIRS_BASE) + """SELECT en, target, language,
  CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', '42', en, target, language)), 1, 8)) AS BIGINT)
            / 4294967296.0 < 0.2 THEN 'test' ELSE 'train' END AS split
FROM valid_pairs"""
_PLACE = """row_number() OVER (ORDER BY
    CAST(('0x' || substr(md5(concat_ws(chr(1), '42', en, target)), 1, 15)) AS BIGINT), conv_id, turn)"""
ORACLE["exact_split"] = _with(PAIRS) + f"""SELECT conv_id, turn,
  CASE WHEN {_PLACE} <= ceil((SELECT count(*) FROM pairs) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM pairs"""
ORACLE["exact_split_floor"] = _with(PAIRS) + f"""SELECT conv_id, turn,
  CASE WHEN {_PLACE} <= floor((SELECT count(*) FROM pairs) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM pairs"""


def _tokens_sql(x: str) -> str:
    return (f"list_filter(string_split_regex({strip(x)}, {_q(WS_RUN)}), lambda t: t <> '')")


VOCAB = f"""toks AS (
  SELECT unnest({_tokens_sql('text')}) AS token FROM documents),
vocab AS (
  SELECT token, count(*) AS count,
         CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 2 AS INTEGER) AS id
  FROM toks GROUP BY token ORDER BY count DESC, token LIMIT 31997)"""

ORACLE["vocab"] = _with(PAIRS, VOCAB) + "SELECT token, count, id FROM vocab"

ENCODED = f"""sides AS (
  SELECT conv_id, turn, 's' AS side, {_tokens_sql("'translate English to kw: ' || en")}[1:128] AS t FROM pairs
  UNION ALL SELECT conv_id, turn, 't', {_tokens_sql('target')}[1:128] FROM pairs),
one AS (SELECT conv_id, turn, side, unnest(t) AS token, generate_subscripts(t, 1) AS p FROM sides),
ids AS (
  SELECT o.conv_id, o.turn, o.side, list(coalesce(v.id, 2) ORDER BY o.p) AS ids
  FROM one o LEFT JOIN vocab v USING (token) GROUP BY o.conv_id, o.turn, o.side),
enc AS (
  SELECT p.conv_id, p.turn, coalesce(s.ids, []::INTEGER[]) AS ids, coalesce(t.ids, []::INTEGER[]) AS lab
  FROM pairs p LEFT JOIN ids s ON s.conv_id = p.conv_id AND s.turn = p.turn AND s.side = 's'
  LEFT JOIN ids t ON t.conv_id = p.conv_id AND t.turn = p.turn AND t.side = 't')"""

ORACLE["encode_fixed"] = _with(PAIRS, VOCAB, ENCODED) + """SELECT conv_id, turn,
  array_to_string(list_concat(ids, list_transform(range(128 - len(ids)), lambda x: 0)), ' ') AS input_ids,
  array_to_string(list_concat(list_transform(range(len(ids)), lambda x: 1), list_transform(range(128 - len(ids)), lambda x: 0)), ' ') AS attention_mask,
  array_to_string(list_concat(lab, list_transform(range(128 - len(lab)), lambda x: 0)), ' ') AS labels
FROM enc"""

ORACLE["decode_ids"] = _with(PAIRS, VOCAB, ENCODED) + """, back AS (
  SELECT conv_id, turn, string_agg(v.token, ' ' ORDER BY p) AS decoded
  FROM (SELECT conv_id, turn, unnest(lab) AS id, generate_subscripts(lab, 1) AS p FROM enc) x JOIN vocab v USING (id)
  GROUP BY conv_id, turn)
SELECT e.conv_id, e.turn, coalesce(b.decoded, '') AS decoded FROM enc e LEFT JOIN back b USING (conv_id, turn)"""


# The public 13a tokenisation rules, in RE2's notation.
TOK13A = [(r"([{-~\[-` -&(-+:-@/])", r" \1 "), (r"([^0-9])([.,])", r"\1 \2 "), (r"([.,])([^0-9])", r" \1 \2"),
          (r"([0-9])(-)", r"\1 \2 ")]


def _tok13a_sql(x: str) -> str:
    s = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    unesc = s
    for a, b in [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]:
        unesc = f"replace({unesc}, {_q(a)}, {_q(b)})"
    s = f"(' ' || CASE WHEN contains({s}, '&') THEN {unesc} ELSE {s} END || ' ')"
    for pat, rep in TOK13A:
        s = f"regexp_replace({s}, {_q(pat)}, {_q(rep)}, 'g')"
    return f"list_filter(string_split_regex({strip(s)}, {_q(WS_RUN)}), lambda t: t <> '')"


def _bleu_sql(source_cte: str, by: str, hyp: str, ref: str, rid: str) -> str:
    grams = []
    for side, col in (("h", "th"), ("r", "tr")):
        for n in range(1, 5):
            hv, rv = (1, 0) if side == "h" else (0, 1)
            grams.append(
                f"SELECT {by}, rid, {n} AS n, unnest(list_transform(range(1, len({col}) - {n} + 2), "
                f"lambda i: array_to_string({col}[i:i + {n - 1}], ' '))) AS g, {hv} AS h, {rv} AS r FROM tok")
    grams_sql = "\n    UNION ALL ".join(grams)
    totals = ", ".join(f"CAST(sum(greatest(len(th) - {n - 1}, 0)) AS BIGINT) AS total_{n}"
                       for n in range(1, 5))
    corrects = ", ".join(f"CAST(coalesce(sum(m) FILTER (WHERE n = {n}), 0) AS BIGINT) AS correct_{n}"
                         for n in range(1, 5))
    return f"""WITH {source_cte},
tok AS (SELECT {by}, {rid} AS rid, {_tok13a_sql(hyp)} AS th, {_tok13a_sql(ref)} AS tr FROM src),
lens AS (SELECT {by}, CAST(sum(len(th)) AS BIGINT) AS sys_len, CAST(sum(len(tr)) AS BIGINT) AS ref_len,
         {totals} FROM tok GROUP BY {by}),
grams AS ({grams_sql}),
clipped AS (SELECT {by}, rid, n, g, least(sum(h), sum(r)) AS m FROM grams GROUP BY {by}, rid, n, g),
corr AS (SELECT {by}, {corrects} FROM clipped GROUP BY {by}),
st AS (SELECT l.*, coalesce(c.correct_1, 0) AS correct_1, coalesce(c.correct_2, 0) AS correct_2,
              coalesce(c.correct_3, 0) AS correct_3, coalesce(c.correct_4, 0) AS correct_4
       FROM lens l LEFT JOIN corr c USING ({by})),
p AS (SELECT *,
  (correct_1 = 0)::INT AS z1, (correct_1 = 0)::INT + (correct_2 = 0)::INT AS z2,
  (correct_1 = 0)::INT + (correct_2 = 0)::INT + (correct_3 = 0)::INT AS z3,
  (correct_1 = 0)::INT + (correct_2 = 0)::INT + (correct_3 = 0)::INT + (correct_4 = 0)::INT AS z4
  FROM st),
pr AS (SELECT *, {", ".join(
        f"CASE WHEN total_{n} = 0 THEN 0.0 WHEN correct_{n} = 0 THEN 100.0 / (pow(2.0, z{n}) * total_{n}) "
        f"ELSE 100.0 * correct_{n} / total_{n} END AS p{n}" for n in range(1, 5))} FROM p)
SELECT {by}, sys_len, ref_len, total_1, total_2, total_3, total_4,
  correct_1, correct_2, correct_3, correct_4,
  round(CASE WHEN correct_1 + correct_2 + correct_3 + correct_4 > 0 THEN
    (CASE WHEN sys_len < ref_len THEN (CASE WHEN sys_len > 0 THEN exp(1.0 - ref_len / sys_len) ELSE 0.0 END) ELSE 1.0 END)
    * exp(({" + ".join(f"(CASE WHEN p{n} > 0 THEN ln(p{n}) ELSE -9999999999.0 END)" for n in range(1, 5))}) / 4.0)
  ELSE 0.0 END, 6) AS bleu
FROM pr"""


ORACLE["corpus_bleu"] = _bleu_sql(PAIRS + ", src AS (SELECT * FROM pairs)", "conv_id", "en", "target", "(conv_id, turn)")
ORACLE["corpus_bleu_docs"] = _bleu_sql(DOC_PAIRS + ", src AS (SELECT * FROM doc_pairs)", "lang", "src", "tgt", "(doc_id, line)")


# --------------------------------------------------------------------------
# Tasks, batches, requests, translation
# --------------------------------------------------------------------------
BOOKS_DIM = VERSES_LONG + """,
books_dim AS (
  SELECT book_name AS book, book_id, CAST(count(DISTINCT chapter) AS INTEGER) AS chapters
  FROM verses_long GROUP BY book_name, book_id)"""

RANGES = """ranges AS (
  SELECT book_id, CAST(i AS INTEGER) AS range_index,
         CAST(i * base + least(i, rem) + 1 AS INTEGER) AS start_chapter,
         CAST((i + 1) * base + least(i + 1, rem) AS INTEGER) AS end_chapter
  FROM (SELECT *, CAST(chapters // k AS INTEGER) AS base, chapters - CAST(chapters // k AS INTEGER) * k AS rem,
               unnest(range(k)) AS i
        FROM (SELECT *, CAST(CASE WHEN chapters <= 30 THEN 1 ELSE ceil(chapters / 30) END AS INTEGER) AS k
              FROM books_dim)))"""

ORACLE["chapter_ranges"] = _with(BOOKS_DIM, RANGES) + \
    "SELECT book_id, range_index, start_chapter, end_chapter FROM ranges"

ORACLE["task_table"] = _with(BOOKS_DIM, RANGES) + """, tasks AS (
  SELECT r.*, v.version FROM ranges r, (SELECT DISTINCT lang AS version FROM documents) v)
SELECT row_number() OVER (ORDER BY CAST(('0x' || substr(md5(concat_ws(chr(1), '42', version,
         CAST(book_id AS VARCHAR), CAST(range_index AS VARCHAR))), 1, 15)) AS BIGINT)) AS task_id,
       version, book_id, start_chapter, end_chapter
FROM tasks"""

BATCHES = DOC_PAIRS + """,
sp AS (SELECT doc_id, line, src AS sl, tgt AS ol FROM doc_pairs),
batches AS (
  SELECT *, CAST(ceil(rn / 30) AS BIGINT) AS batch_id FROM (
    SELECT *, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(concat_ws(chr(1), '42',
        CAST(doc_id AS VARCHAR), CAST(line AS VARCHAR))), 1, 15)) AS BIGINT), doc_id, line) AS rn FROM sp)),
chunked AS (
  SELECT *, CAST(ceil((rn - (batch_id - 1) * 30) /
     (10 + CAST(('0x' || substr(md5('42|' || CAST(batch_id AS VARCHAR)), 1, 8)) AS BIGINT) % 16)) AS BIGINT) AS chunk_id
  FROM batches),
req AS (
  SELECT batch_id, chunk_id, list(struct_pack(rn := rn, sl := sl, ol := ol) ORDER BY rn) AS sentences,
         string_agg(sl, ' <|||> ' ORDER BY rn) AS request, count(*) AS n_sentences
  FROM chunked GROUP BY batch_id, chunk_id)"""

ORACLE["batches"] = _with(BATCHES) + "SELECT doc_id, line, rn, batch_id FROM batches"
ORACLE["requests"] = _with(BATCHES) + "SELECT batch_id, chunk_id, n_sentences, request FROM req"

_REALIGN = """, res AS (SELECT *, translate(request, 'abcdefghijklmnopqrstuvwxyz',
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS translated FROM req),
parts AS (SELECT *, string_split(translated, '<|||>') AS p FROM res),
zipped AS (
  SELECT batch_id, chunk_id, len(p) <> n_sentences AS bad, unnest(sentences) AS s,
         unnest(CASE WHEN len(p) = n_sentences THEN p
                     ELSE list_transform(sentences, lambda x: NULL::VARCHAR) END) AS part
  FROM parts)
SELECT batch_id, chunk_id, s.rn AS rn, {sl} AS sl,
       CASE WHEN bad THEN '[ERROR]' ELSE {tl} END AS tl, {ol} AS ol
FROM zipped""".format(sl=collapse("s.sl"), ol=collapse("s.ol"), tl=clean_text("part"))

ORACLE["realign"] = _with(BATCHES) + _REALIGN
ORACLE["translate_batches"] = _with(BATCHES) + _REALIGN
ORACLE["translate_pairs"] = _with(BATCHES) + f"""SELECT batch_id, chunk_id, rn + i - 1 AS rn,
  {strip('sl')} AS sl, translate({strip('sl')}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS tl, ol
FROM (SELECT batch_id, chunk_id, sentences[1].rn AS rn, {strip('request')} AS ol,
             unnest(string_split(request, '<|||>')) AS sl,
             generate_subscripts(string_split(request, '<|||>'), 1) AS i FROM req)"""
ORACLE["map_batched"] = f"""SELECT doc_id, CAST(len(list_filter(string_split_regex(text, {_q(WS_RUN)}), lambda t: t <> '')) AS BIGINT) AS n_words
FROM documents"""
ORACLE["split_status"] = _with(BATCHES) + """SELECT batch_id, chunk_id,
  CASE WHEN chunk_id = 1 AND n_sentences > 1 THEN 'split_mismatch' ELSE 'ok' END AS status FROM req"""


# --------------------------------------------------------------------------
# Pages, segments and text functions
# --------------------------------------------------------------------------
def _html_text(x: str) -> str:
    s = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = f"replace({s}, {_q(a)}, {_q(b)})"
    return strip(s)


_CONTAINERS = f"""list_transform(string_split(html, '<p>')[2:],
      lambda p, i: struct_pack(label := CASE WHEN (i - 1) % 3 <> 2 THEN CAST(i AS INTEGER) END,
                               text := {_html_text("split_part(p, '</p>', 1)")},
                               note := i % 4 = 0))"""

_FOLD = """list_reduce(containers, lambda acc, x:
      CASE WHEN x.text <> '' AND x.label IS NOT NULL THEN
             list_append(CASE WHEN x.label > len(acc) + 1 THEN list_append(acc, '') ELSE acc END, x.text)
           WHEN x.text <> '' AND len(acc) > 0 THEN
             list_append(acc[1:len(acc) - 1], acc[len(acc)] || ' ' || x.text)
           WHEN x.text = '' AND x.note THEN list_append(acc, '')
           ELSE acc END, []::VARCHAR[])"""

ORACLE["extract_verses"] = f"""WITH c AS (
  SELECT page_id, {_CONTAINERS} AS containers
  FROM pages),
f AS (SELECT page_id, CASE WHEN len(containers) = 0 THEN []::VARCHAR[] ELSE {_FOLD} END AS v FROM c)
SELECT page_id, CAST(generate_subscripts(v, 1) AS INTEGER) AS verse, unnest(v) AS text FROM f"""

_ITEM = _q('(?s)<li><a href="([^"]*)">(.*?)</a></li>')
ORACLE["extract_table_pairs"] = f"""WITH z AS (
  SELECT page_id, regexp_extract_all(html, {_ITEM}, 1) AS a, regexp_extract_all(html, {_ITEM}, 2) AS b
  FROM pages),
found AS (
  SELECT page_id, len(a) // 2 AS n, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS idx,
         unnest(a) AS a1, unnest(b) AS b1
  FROM z WHERE len(a) > 0)
SELECT page_id, idx, CASE WHEN idx % 2 = 1 THEN 'even' ELSE 'odd' END AS cls,
  CAST(CASE WHEN idx % 2 = 1 THEN idx // 2 ELSE n + idx // 2 END AS INTEGER) AS out_pos,
  {strip("replace(a1, '\"', '''')")} AS en, {strip("replace(b1, '\"', '''')")} AS kw, 'ok' AS status
FROM found
UNION ALL
SELECT page_id, NULL, NULL, NULL, NULL, NULL, 'not_found' FROM z WHERE len(a) = 0"""

ORACLE["page_not_found"] = """SELECT page_id,
  CASE WHEN contains(html, '<p>') THEN 'ok' ELSE 'not_found' END AS status FROM pages"""

BENCH_LINES = """blines AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS text FROM benchmark)"""

ORACLE["curate_text"] = _with(VERSES_LONG, BENCH_LINES) + f"""SELECT doc_id, verse,
  CASE WHEN {has_invalid_characters('text')} THEN 'corrupted' ELSE 'curated' END AS label
FROM verses_long v WHERE NOT EXISTS (SELECT 1 FROM blines b WHERE b.text = v.text)"""

ORACLE["exclude_sentences"] = _with(VERSES_LONG, BENCH_LINES) + """SELECT doc_id, count(*) AS kept_lines
FROM verses_long v WHERE NOT EXISTS (SELECT 1 FROM blines b WHERE b.text = v.text)
GROUP BY doc_id"""

ORACLE["nested_pairs"] = _with(DOC_PAIRS) + \
    "SELECT src AS br, tgt AS en FROM doc_pairs WHERE src IS NOT NULL AND tgt IS NOT NULL"

ORACLE["clean_text"] = f"SELECT doc_id, {clean_text('text')} AS cleaned FROM documents"
ORACLE["collapse_ws"] = f"SELECT doc_id, {collapse('text')} AS collapsed FROM documents"
ORACLE["strip_text"] = f"""SELECT conv_id, turn, {strip('text')} AS stripped,
  substr(text, 1, 50) AS preview, CAST(length(text) AS INTEGER) AS n_chars FROM conversations"""
ORACLE["quotes"] = "SELECT doc_id, replace(text, '\"', '''') AS text FROM documents"


def sanitize_name(x: str, max_len: int = 80) -> str:
    stem = f"substr({x}, 1, length({x}) - length({extension(x)}))"
    s = (f"array_to_string(list_transform(string_split({stem}, ''), "
         f"lambda c: CASE WHEN contains({_q(SAFE_NAME_CHARS)}, c) THEN c ELSE '_' END), '')")
    s = f"regexp_replace({s}, '_+', '_', 'g')"
    s = f"regexp_replace({s}, '^[._\\-]+|[._\\-]+$', '', 'g')"
    e2 = extension(s)
    long_ = (f"CASE WHEN length({e2}) > 0 AND length({e2}) <= 10 THEN "
             f"substr({s}, 1, least(length({s}) - length({e2}), {max_len} - length({e2}))) || {e2} "
             f"ELSE substr({s}, 1, {max_len}) END")
    out = f"CASE WHEN length({s}) > {max_len} THEN {long_} ELSE {s} END"
    return f"CASE WHEN {x} IS NULL OR {x} = '' OR {s} = '' THEN 'unnamed' ELSE {out} END"


ORACLE["sanitize_name"] = f"""SELECT page_id,
  {sanitize_name("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title_name,
  {sanitize_name('url')} AS url_name FROM pages"""

ORACLE["url_params"] = """WITH q AS (
  SELECT page_id, url, CASE WHEN contains(url, '?') THEN regexp_extract(url, '\\?([^#]*)', 1) END AS qs
  FROM pages),
kv AS (
  SELECT page_id, url, qs,
    list_filter(list_transform(list_filter(string_split(qs, '&'), lambda p: strpos(p, '=') > 1),
        lambda p: struct_pack(k := url_decode(split_part(p, '=', 1)), v := url_decode(substr(p, strpos(p, '=') + 1)))),
      lambda x: x.v <> '') AS kv
  FROM q)
SELECT page_id,
  CASE WHEN qs IS NULL THEN NULL ELSE array_to_string(list_transform(
    list_filter(kv, lambda x, i: NOT list_contains(list_transform(kv[1:i - 1], lambda y: y.k), x.k)),
    lambda x: x.k || '=' || array_to_string(list_transform(list_filter(kv, lambda y: y.k = x.k), lambda y: y.v), '|')),
    ';') END AS params,
  (SELECT any_value(x.v) FROM (SELECT unnest(list_filter(kv, lambda y: y.k = 'page')) AS x)) AS page
FROM kv"""

ORACLE["url_language_check"] = """SELECT page_id, url_lang, page_lang, url_lang <> page_lang AS mismatch FROM (
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) AS url_lang,
         regexp_extract(html, '<html lang="([^"]*)"', 1) AS page_lang FROM pages)"""

ORACLE["chapter_url"] = _with(VERSES_LONG) + """SELECT version, book_name, chapter,
  format('https://www.bible.com/bible/{}/{}.{}.{}',
         CASE version """ + " ".join(f"WHEN '{v}' THEN {i + 1}" for i, v in enumerate(VERSIONS)) + """ END,
         upper(substr(book_name, 1, 3)), chapter + 1, upper(version)) AS url
FROM (SELECT DISTINCT version, book_name, chapter FROM verses_long)"""


def _translator_url() -> str:
    hosts = ", ".join(_q(h) for h in HOSTS)
    return (f"[{hosts}][1 + CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 3]"
            f" || '/?sl=' || lang || '&tl=en&op=translate'")


def _language_name() -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in LANGUAGES.items())
    return f"CASE lang {cases} ELSE lang END"


ORACLE["translator_url"] = f"""SELECT doc_id, {_translator_url()} AS url, {_language_name()} AS language
FROM documents"""


# --------------------------------------------------------------------------
# Profiles, previews, exports, previous runs, ingest
# --------------------------------------------------------------------------
ORACLE["query_param_mismatch"] = f"""SELECT doc_id, {_translator_url()} AS url, lang <> 'fr' AS mismatch FROM documents"""

ORACLE["table_profile"] = f"""SELECT count(*) AS n_rows,
  'bigint' AS conv_id__type, 'bigint' AS turn__type, 'string' AS role__type, 'string' AS text__type,
  CAST(min(conv_id) AS VARCHAR) AS conv_id__example, CAST(min(turn) AS VARCHAR) AS turn__example,
  min(role) FILTER (WHERE {strip('role')} <> '') AS role__example, min(text) FILTER (WHERE {strip('text')} <> '') AS text__example,
  count(*) FILTER (WHERE conv_id IS NULL) AS conv_id__nulls,
  count(*) FILTER (WHERE turn IS NULL) AS turn__nulls,
  count(*) FILTER (WHERE role IS NULL) AS role__nulls,
  count(*) FILTER (WHERE {strip('role')} = '') AS role__blanks,
  count(*) FILTER (WHERE text IS NULL) AS text__nulls,
  count(*) FILTER (WHERE {strip('text')} = '') AS text__blanks
FROM conversations"""

ORACLE["preview"] = _with(*ALIGN_BASE) + """SELECT book_name, chapter, verse, en_text FROM merged
ORDER BY book_id, chapter, verse LIMIT 5"""

ORACLE["version_books"] = _with(VERSES_LONG) + """SELECT version, book_name, count(*) AS book_entries,
  CAST(sum(count(*)) OVER (PARTITION BY version) AS BIGINT) AS entries, count(*) OVER (PARTITION BY version) AS n_books
FROM verses_long GROUP BY version, book_name"""

ORACLE["render_text"] = _with(VERSES_LONG) + """, """ + BOOKS + """,
e AS (SELECT v.version, v.book_id, v.chapter, v.verse, v.text, b.name AS bname, b.ordinal AS book_ord
      FROM verses_long v LEFT JOIN books b ON v.book_id = b.id),
ch AS (SELECT DISTINCT version, book_id, book_ord, bname, chapter FROM e),
fl AS (SELECT version, book_id, min(chapter) AS first_ch, max(chapter) AS last_ch FROM ch GROUP BY 1, 2),
c AS (SELECT ch.*, fl.first_ch, fl.last_ch FROM ch JOIN fl USING (version, book_id))
SELECT version, NULL::INTEGER AS book_ord, NULL::INTEGER AS chapter, 0 AS kind, 0 AS verse, 0 AS seq,
       'The Holy Bible - ' || version AS value FROM (SELECT DISTINCT version FROM ch)
UNION ALL SELECT version, NULL, NULL, 0, 0, 1, '' FROM (SELECT DISTINCT version FROM ch)
UNION ALL SELECT version, book_ord, NULL, 1, 0, 0, bname FROM c WHERE chapter = first_ch
UNION ALL SELECT version, book_ord, NULL, 1, 0, 1, repeat('=', 50) FROM c WHERE chapter = first_ch
UNION ALL SELECT version, book_ord, NULL, 1, 0, 2, '' FROM c WHERE chapter = first_ch
UNION ALL SELECT version, book_ord, chapter, 2, 0, 0, 'Chapter ' || CAST(chapter AS VARCHAR) FROM c
UNION ALL SELECT version, book_ord, chapter, 2, 0, 1, repeat('-', 20) FROM c
UNION ALL SELECT version, book_ord, chapter, 3, verse, 0, CAST(verse AS VARCHAR) || ' ' || coalesce(text, '') FROM e
UNION ALL SELECT version, book_ord, chapter, 4, 0, 0, '' FROM c
UNION ALL SELECT version, book_ord, chapter, 5, 0, 0, '' FROM c WHERE chapter = last_ch"""

RUNS = """runs AS (
  SELECT event_id, ts, user_id, event_type, strftime(date_trunc('day', ts), '%Y%m%d_%H%M%S') AS run_id
  FROM events),
ranked AS (SELECT run_id, dense_rank() OVER (ORDER BY run_id DESC) AS run_rank
           FROM (SELECT DISTINCT run_id FROM runs))"""

ORACLE["latest_run"] = _with(RUNS) + """SELECT event_id, run_id FROM runs
WHERE run_id IN (SELECT run_id FROM ranked WHERE run_rank = 2)"""

ORACLE["newest_per_key"] = _with(RUNS) + """SELECT user_id, event_id, run_id FROM runs
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["todo_tasks"] = _with(RUNS) + """SELECT DISTINCT event_type, user_id FROM runs r
WHERE NOT EXISTS (SELECT 1 FROM runs d JOIN ranked k ON d.run_id = k.run_id AND k.run_rank = 1
                  WHERE d.event_type = r.event_type AND d.user_id = r.user_id)"""

ORACLE["ingest_partials"] = _with(TRANSLATIONS) + """SELECT DISTINCT sl, tl FROM translations
WHERE coalesce(sl, '') <> coalesce(tl, '') AND NOT contains(coalesce(sl, ''), '[ERROR]')
  AND NOT contains(coalesce(tl, ''), '[ERROR]')"""


# --------------------------------------------------------------------------
# Remaining predicates and helpers
# --------------------------------------------------------------------------
ORACLE["degenerate_translations"] = _with(TRANSLATIONS) + f"""SELECT doc_id, line,
  {is_blank('tl')} OR coalesce(lower(tl) = lower(sl), FALSE) AS degenerate,
  {is_blank('tl')} OR coalesce(tl = sl, FALSE) AS same_exact
FROM translations"""

ORACLE["range_label"] = _with(*ALIGN_FULL, MAJORITY, STATS, SUSPICIOUS) + """SELECT
  w.book_name, w.chapter, w.verse,
  CASE WHEN sp.split_verse IS NULL OR w.verse < sp.split_verse THEN 'prefix' ELSE 'suffix' END AS side
FROM merged w LEFT JOIN split sp USING (book_name, chapter)"""

ORACLE["zip_lines"] = _with(PAIRS) + """, z AS (
  SELECT conv_id, turn, string_split(en, chr(10)) AS a, string_split(target, chr(10)) AS b FROM pairs)
SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS i, a[i] AS a, b[i] AS b
FROM (SELECT *, unnest(range(1, least(len(a), len(b)) + 1)) AS i FROM z)"""

_SEG = "(?s)<tuv xml:lang=\"{l}\">\\s*<seg>(.*?)</seg>"
ORACLE["tmx_blocks"] = _with(DOC_PAIRS, BENCH_LINES) + f""", blocks AS (
  SELECT doc_id, line, '<tu>' || chr(10) || '<tuv xml:lang="br"><seg>' || src || '</seg></tuv>' || chr(10)
         || '<tuv xml:lang="en"><seg>' || tgt || '</seg></tuv>' || chr(10) || '</tu>' AS block
  FROM doc_pairs),
segs AS (
  SELECT doc_id, line, block,
    CASE WHEN regexp_matches(block, {_q(_SEG.format(l='br'))}) THEN regexp_extract(block, {_q(_SEG.format(l='br'))}, 1) END AS br,
    CASE WHEN regexp_matches(block, {_q(_SEG.format(l='en'))}) THEN regexp_extract(block, {_q(_SEG.format(l='en'))}, 1) END AS en
  FROM blocks)
SELECT doc_id, line,
  CASE WHEN br IS NOT NULL AND {has_invalid_characters('br')} THEN 'corrupted' ELSE 'curated' END AS label,
  en
FROM segs s WHERE NOT EXISTS (SELECT 1 FROM blines b WHERE b.text = s.br)"""

ORACLE["name_parts"] = f"""WITH p AS (
  SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) AS lang FROM pages),
q AS (
  SELECT *, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS u1,
         regexp_extract(url, '([^/]*)$', 1) AS base FROM p)
SELECT page_id,
  CASE WHEN starts_with(u1, 'http://') THEN substr(u1, 8) ELSE u1 END AS no_scheme,
  substr(base, 1, length(base) - length({extension('base')})) AS stem,
  lower(lang) || '_text' AS text_key,
  {strip("split_part(lang || chr(9) || url, chr(9), 1)")} AS tab_first
FROM q"""

ORACLE["alignment_report_text"] = _with(*ALIGN_FULL, MAJORITY, STATS, SUSPICIOUS) + """,
sides AS (
  SELECT w.book_name, w.chapter, count(*) FILTER (WHERE w.verse < s.split_verse) AS n_good,
         count(*) FILTER (WHERE w.verse >= s.split_verse) AS n_suspect
  FROM merged w JOIN sv s USING (book_name, chapter) GROUP BY 1, 2),
ctext AS (
  SELECT c.book_name, c.chapter,
         string_agg('''' || c.version || '_text'': ' || CAST(c.n AS VARCHAR), ', '
                    ORDER BY c.n, c.first_verse, c.ordinal) AS counts_txt,
         coalesce(string_agg(CASE WHEN c.n <> h.majority THEN c.version END, ', '
                    ORDER BY c.first_verse, c.ordinal), '') AS outliers_txt
  FROM counts c JOIN chap h USING (book_name, chapter) WHERE h.n_distinct > 1
  GROUP BY c.book_name, c.chapter)
SELECT m.book_name, m.chapter,
  m.book_name || ' ' || CAST(m.chapter AS VARCHAR) || chr(10)
  || 'Verse counts per version: {' || t.counts_txt || '}' || chr(10)
  || 'Majority has ' || CAST(m.majority AS VARCHAR) || ' verses' || chr(10)
  || 'Outlier versions (wrong count): ' || t.outliers_txt || chr(10)
  || CASE WHEN s.split_verse IS NULL
          THEN '  -> No suspicious merge detected - whole chapter to good prefix'
          ELSE '  -> Split at verse ' || CAST(s.split_verse AS VARCHAR) || ' (good prefix: '
               || CAST(d.n_good AS VARCHAR) || ', suffix: ' || CAST(d.n_suspect AS VARCHAR)
               || ', suspects: ' || replace(s.suspects, ',', ', ') || ')' END AS report
FROM mo m JOIN ctext t USING (book_name, chapter)
LEFT JOIN sv s USING (book_name, chapter) LEFT JOIN sides d USING (book_name, chapter)"""


# --------------------------------------------------------------------------
# Sources, sinks and small operators
# --------------------------------------------------------------------------
ORACLE["read_json_arrays"] = "SELECT doc_id, lang, text, NULL::VARCHAR AS _corrupt_record FROM documents"
ORACLE["write_json"] = _with(TRANSLATIONS) + f"""SELECT doc_id, line, sl, tl,
  CASE WHEN is_duplicate THEN 'duplicates' ELSE 'unique' END AS part
FROM ({_first_label('translations', 'sl', 'tl')})"""
_CELL = {c: f"nullif({clean_text(c)}, '')" for c in ("sl", "tl")}
ORACLE["csv_round_trip"] = _with(TRANSLATIONS) + f"""SELECT doc_id || '-' || line AS key, {_CELL['sl']} AS sl,
  {_CELL['tl']} AS tl, NULL::VARCHAR AS note,
  CASE WHEN starts_with(tl, '[ERROR]') THEN 'error' WHEN starts_with(tl, '[TRANSLATION FAILED]') THEN 'failed'
       WHEN starts_with(tl, '[TRANSLATION BACK FROM en]') THEN 'back' ELSE 'ok' END AS status
FROM translations"""
ORACLE["quoted_csv"] = _with(*PAIRS_BASE) + "SELECT en, target FROM valid_pairs"
ORACLE["read_tmx"] = _with(DOC_PAIRS) + """SELECT trim(src) AS source, trim(tgt) AS target, 'br' AS source_language,
  'en' AS target_language FROM doc_pairs"""
ORACLE["read_pairs"] = _with(DOC_PAIRS) + f"""SELECT DISTINCT src, tgt FROM doc_pairs
WHERE NOT {is_blank('src')} AND NOT {is_blank('tgt')}"""
ORACLE["previous_run"] = _with(TRANSLATIONS) + """SELECT '20240102_093000' AS run_id, doc_id, line, sl, tl
FROM translations WHERE doc_id % 3 = 1"""
ORACLE["version_names"] = """SELECT 'Version ' || lang AS name,
  CAST(list_position(['en', 'fr', 'de', 'es'], lang) - 1 AS INTEGER) AS id, count(*) AS n_documents
FROM documents WHERE lang IN ('en', 'fr', 'de', 'es') GROUP BY lang"""
ORACLE["read_pages"] = "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages"
ORACLE["write_partials"] = _with(TRANSLATIONS) + """SELECT doc_id AS batch_id, doc_id, line, sl, tl FROM translations
WHERE tl IS DISTINCT FROM sl AND doc_id NOT IN (SELECT doc_id FROM translations WHERE starts_with(tl, '['))"""
ORACLE["split_outputs"] = _with(PAIRS) + """SELECT conv_id, turn,
  CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', '42', en, target)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.2
       THEN 'test' ELSE 'train' END AS split, TRUE AS verified
FROM pairs"""
ORACLE["log_of_batch"] = _with(_log_cte()) + """SELECT worker, batch, count(*) AS n_lines FROM parsed
WHERE batch IS NOT NULL GROUP BY worker, batch"""
ORACLE["select_pair"] = _with(DOC_PAIRS) + "SELECT src AS en, tgt AS target FROM doc_pairs"
ORACLE["drop_keys"] = "SELECT doc_id, lang, source FROM documents"
ORACLE["ensure_columns"] = "SELECT doc_id, lang, '' AS kw_text FROM documents"
ORACLE["version_columns"] = _with(*ALIGN_FULL) + "SELECT version, count(*) AS n_texts FROM present GROUP BY version"
ORACLE["double_prompts"] = _with(*PAIRS_BASE) + """SELECT en, target, language,
  'translate English to Breton: ' || language || ': ' || en AS prompt FROM valid_pairs"""
ORACLE["verse_labels"] = """SELECT page_id, part, regexp_matches(part, '^[0-9]+$') AS is_label
FROM (SELECT page_id, regexp_extract(url, '://[^/]*(?:/[^/?#]*)*/([^/?#]*)', 1) AS part FROM pages)"""
ORACLE["label_chapters"] = _with(*ALIGN_FULL, STATUS) + """SELECT book_name, chapter, verse, status
FROM merged JOIN status USING (book_name, chapter)"""
ORACLE["shuffle_order"] = """SELECT doc_id, row_number() OVER (ORDER BY
  CAST(('0x' || substr(md5(concat_ws(chr(1), '42', CAST(doc_id AS VARCHAR))), 1, 15)) AS BIGINT), doc_id) AS rn
FROM documents"""
ORACLE["even_then_odd"] = f"""SELECT page_id, cls, idx, en, row_number() OVER (ORDER BY cls = 'odd', idx, page_id) AS place
FROM ({ORACLE['extract_table_pairs']}) WHERE status = 'ok'"""
ORACLE["join_spans"] = f"SELECT doc_id, {strip('replace(text, chr(10), ' + repr('') + ')')} AS joined FROM documents"
ORACLE["complete_batches"] = _with(_log_cte()) + """SELECT line_no, batch FROM parsed p
WHERE batch IS NOT NULL AND NOT EXISTS (SELECT 1 FROM parsed e WHERE e.batch = p.batch AND e.level = 'ERROR')"""
