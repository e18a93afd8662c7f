"""Registered queries of the training-data operators and their DuckDB twins.

Each query applies its operator to the whole table with the parameters below;
``ORACLE`` holds SQL only where SQL can state the result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcorpus.llm import (bpe, chat, decontam, hardneg, hilbert, langid, lexical, linededup, ngramjoin, pii, quality,
                           urlfilter, warc)
from parcorpus.llm.common import drop_folder, table
from parcorpus.session import scratch_path

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("host_rate", 6).alias("host_rate"))


#: (verdict, host, path prefix) of the query's rules.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the pages that mirror an earlier one: their titles are equal."""
    pages = table(spark, sf_dir, "pages")
    listed = urlfilter.mirrors(pages)
    return urlfilter.judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def token_digests(docs: DataFrame) -> DataFrame:
    """Ids of every text, their digest and that of the bytes decoded from them."""
    ranks, pattern = vocabulary()
    coded = bpe.decode(bpe.encode(docs, ranks, pattern, keep_text=False), ranks)
    return coded.select(
        *[c for c in docs.columns if c not in ("text", "ids", "decoded")], "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("ids")


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "perspective", "segment", F.col("n_turns").cast("long").alias("n_turns"),
                      "start_char", "text", F.array_join(F.transform(
                          "mask_spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("mask"))


SHARDS = 24


@query
def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    meta = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    sharded = hilbert.hilbert_shards(meta, ["lang", "source", "size"], ["doc_id", "text_crc32", "size"], SHARDS)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "hilbert")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contaminated(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "item_id", F.round("coverage", 6).alias("coverage"),
                        F.size("tiles").cast("long").alias("n_tiles"))


#: The query's key. A real run passes its own secret.
SURROGATE_KEY = b"an example key"


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, SURROGATE_KEY)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_deleted", F.size("runs").cast("long").alias("n_runs"), "text")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
    return found.select("page_id", "declared", "lang", F.round("confidence", 6).alias("confidence"), "text_lang")


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hardneg.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=moved).drop("positive_rank")


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write_archive(table(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    records = warc.read_archive(spark, path, payload=False)  # parsed by now: the archives are no longer needed
    drop_folder(spark, path)

    def own(name: str):
        return F.regexp_extract(name, "^<urn:record:([0-9-]+):", 1).try_cast("long")

    return records.where(F.col("type").isin("response", "revisit")).select(
        own("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        own("refers_to").alias("refers_to"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --------------------------------------------------------------------------
# DuckDB twins
# --------------------------------------------------------------------------
_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_WORDED = r"list_filter(string_split({}, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"

ORACLE["op1_quality_rules"] = f"""WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS.format('t')} AS w, {_WORDED.format('t')} AS l FROM d),
g AS (SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
m AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines
  FROM w LEFT JOIN c USING (rid)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 50 * n_words, 100 * n_dup_lines > 50 * n_lines] AS bad
  FROM m),
h AS (
  SELECT source, k, count(*) AS n, count(*) FILTER (WHERE bad[k]) AS x FROM f, range(1, 5) r(k)
  WHERE source IS NOT NULL GROUP BY source, k),
p AS (SELECT k, sum(x) / sum(n) AS m, sum(n * (x / n) * (x / n)) / sum(n) AS m2 FROM h GROUP BY k),
b AS (
  SELECT source, max((x + m * v) / (n + v)) AS rate FROM h JOIN (
    SELECT k, m, CASE WHEN m2 - m * m > 0 THEN greatest(2.0, least(1000.0, m * (1 - m) / (m2 - m * m) - 1)) ELSE 1000.0 END AS v
    FROM p) USING (k) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept, round(rate, 6) AS host_rate
FROM f LEFT JOIN b USING (source)"""

ORACLE["op2_url_filter"] = """WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
    nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages),
s AS (
  SELECT page_id, title IS NOT NULL AND page_id > min(page_id) OVER (PARTITION BY title) AS mirror,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS query
  FROM u),
c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '') || '?' ||
      array_to_string(list_sort(list_filter(string_split(query, '&'),
        lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&') END AS canon,
    CASE WHEN starts_with(path, '/en/') AND (host = 'www.example.com' OR ends_with(host, '.www.example.com')) THEN 'www.example.com/en/'
         WHEN starts_with(path, '/en/') AND (host = 'example.com' OR ends_with(host, '.example.com')) THEN 'example.com/en/'
         WHEN starts_with(path, '/es/') AND (host = 'net' OR ends_with(host, '.net')) THEN 'net/es/'
         WHEN starts_with(path, '/fr/') AND (host = 'net' OR ends_with(host, '.net')) THEN 'net/fr/'
         WHEN starts_with(path, '/') AND (host = 'com' OR ends_with(host, '.com')) THEN 'com/' END AS rule
  FROM s)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN EXISTS (SELECT 1 FROM c l WHERE l.canon = c.canon AND l.mirror) THEN 'block'
       ELSE 'allow' END AS verdict
FROM c"""

ORACLE["op4_chat_format"] = """WITH t AS (
  SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text) - 1 AS k,
    replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
x AS (
  SELECT conv_id, perspective, k // 128 AS segment, k, coalesce(role = perspective, FALSE) AS own, body,
    CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = perspective THEN '<|assistant|>' || chr(10)
         ELSE '<|user|>' || chr(10) || coalesce(role, 'unknown') || ': ' END AS head
  FROM t JOIN p USING (conv_id)),
y AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, segment ORDER BY k) AS e
  FROM x),
z AS (
  SELECT conv_id, perspective, segment, count(*) AS n_turns, string_agg(head || body, '' ORDER BY k) AS text,
    coalesce(string_agg(CASE WHEN own THEN CAST(e - length(body) AS VARCHAR) || '-' || CAST(e AS VARCHAR) END, ',' ORDER BY k), '') AS mask
  FROM y GROUP BY conv_id, perspective, segment)
SELECT conv_id, perspective, segment, n_turns, text, mask, CAST(coalesce(sum(length(text)) OVER (
  PARTITION BY conv_id, perspective ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char
FROM z"""

ORACLE["op7_line_dedup"] = rf"""WITH raw AS (
  SELECT doc_id, l[i] AS x, i AS r FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
s AS (
  SELECT doc_id, r, x, row_number() OVER (PARTITION BY doc_id ORDER BY r) AS p, lead(x) OVER (PARTITION BY doc_id ORDER BY r) AS y
  FROM raw WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
hit AS (
  SELECT doc_id, p, p + 1 AS q FROM s WHERE y IS NOT NULL QUALIFY row_number() OVER (PARTITION BY x, y ORDER BY doc_id, p) > 1
  UNION ALL
  SELECT doc_id, p, p FROM s WHERE len({_WORDS.format('x')}) >= 50 QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([p, q]) AS p FROM hit),
runs AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE first) AS n_runs
  FROM (SELECT doc_id, coalesce(p > 1 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), TRUE) AS first FROM gone) GROUP BY doc_id),
marked AS (
  SELECT raw.doc_id, raw.r, raw.x, s.p, gone.p IS NOT NULL AS dead,
    max(CASE WHEN s.p IS NOT NULL THEN s.p END) OVER (PARTITION BY raw.doc_id ORDER BY raw.r) AS before
  FROM raw LEFT JOIN s USING (doc_id, r) LEFT JOIN gone ON gone.doc_id = raw.doc_id AND gone.p = s.p),
kept AS (
  SELECT m.doc_id, string_agg(m.x, chr(10) ORDER BY m.r) AS text FROM marked m
  LEFT JOIN gone a ON m.p IS NULL AND a.doc_id = m.doc_id AND a.p = m.before
  LEFT JOIN gone b ON m.p IS NULL AND b.doc_id = m.doc_id AND b.p = m.before + 1
  WHERE NOT m.dead AND (a.p IS NULL OR b.p IS NULL) GROUP BY m.doc_id),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(size.n, 0) AS n_lines, coalesce(runs.n, 0) AS n_deleted, coalesce(runs.n_runs, 0) AS n_runs,
  coalesce(kept.text, '') AS text
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLE["op10_ngram_jaccard"] = f"""WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
  least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)"""

ORACLE["op11_hard_negatives"] = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

ORACLE["op12_warc"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
b AS (
  SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest
  FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY hex ORDER BY page_id) AS k, min(page_id) OVER (PARTITION BY hex) AS least FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN least END AS refers_to
FROM r"""

_TERMS = r"""regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op13_lexical_search"] = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format('text')} AS t FROM documents),
n AS (SELECT rid, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY rid, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
q AS (SELECT item, item_id, term, count(*) AS times
      FROM (SELECT row_number() OVER () AS item, item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark) GROUP BY ALL),
s AS (
  SELECT item, item_id, rid, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (rid), c GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""
