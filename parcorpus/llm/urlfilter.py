"""Operator 2: URL filters.

Prefix rules on (host, path) decide first. Where no rule fits, the canonical
URL is looked up in a list: a blocked Bloom filter over the listed URLs, held
as a table of bit blocks, lets only possible hits pass to an exact hash join,
which removes the false positives.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no canonical URL and the verdict ``allow``. An empty list blocks
nothing. Rules of equal length: the first of the list counts. Urls may be of any
length. An empty table gives an empty result. Repeated rows are judged one by one; only the named columns are read,
so further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.llm.common import ascii_lower, fingerprint, written

LANES = 4
#: A filter has 2**LOG2_BLOCKS rows at least, of one block number and LANES longs (2.6 MB), and one for each
#: KEYS_PER_BLOCK keys beyond. A filter of up to 2**LOG2_SENT rows (10.5 MB) is sent to all tasks, a larger one shuffled.
LOG2_BLOCKS = 16
LOG2_SENT = 18
KEYS_PER_BLOCK = 16
#: Copies of the list in the exact join, so that a URL on a third of all rows is spread over as many tasks.
SALTS = 16
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)="


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Host and path without scheme, default port, final slash, fragment and
    tracking parameters, the other parameters sorted; null without a host."""
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(_rest(url), "^[^?#]*[?]([^#]*)", 1)
    kept = F.array_join(F.sort_array(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def rule_column(rules: list[tuple[str, str, str]], host: Column, path: Column, what: int) -> Column:
    """Rule text (``what`` 0) or verdict (1) of the longest fitting rule, else
    null. ``rules``: (verdict, host, path prefix); a host covers its subdomains."""
    picks = []
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        picks.append(F.when(fits, F.lit([h + p, verdict][what])))
    return F.coalesce(*picks) if picks else F.lit(None).cast("string")


def log2_blocks(keys: int) -> int:
    """The size of a filter over so many keys (or a bound of them)."""
    return max(LOG2_BLOCKS, (max(keys - 1, 0) // KEYS_PER_BLOCK).bit_length())


def _bits(key: Column, log2: int) -> tuple[Column, list[Column]]:
    """Block number, and one bit per lane of the block, of a key."""
    pick, spread = fingerprint(key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftright(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(LANES)]
    return F.pmod(pick, F.lit(1 << log2)), bits


def bloom_blocks(listed: DataFrame, key: str, log2: int = LOG2_BLOCKS) -> DataFrame:
    """The filter over ``listed[key]``: one row per block that has a bit set."""
    block, bits = _bits(F.col(key), log2)
    return listed.where(F.col(key).isNotNull()).select(
        block.alias("_block"), *[b.alias(f"_b{k}") for k, b in enumerate(bits)]
    ).groupBy("_block").agg(*[F.bit_or(f"_b{k}").alias(f"_b{k}") for k in range(LANES)])


def with_maybe(df: DataFrame, key: str, blocks: DataFrame, maybe: str = "_maybe", log2: int = LOG2_BLOCKS) -> DataFrame:
    """Add ``maybe``: true for every key in the filter and few others.

    ``log2`` is that of ``blocks``. A larger filter is joined by shuffle, its blocks in SALTS copies,
    so that a key on many rows is spread."""
    block, bits = _bits(F.col(key), log2)
    hit = F.lit(True)
    for k, b in enumerate(bits):
        hit = hit & (F.col(f"_b{k}").bitwiseAND(b) != 0)
    rows = df.withColumn("_at", block)
    if log2 <= LOG2_SENT:
        met = rows.join(F.broadcast(blocks), F.col("_at") == F.col("_block"), "left")
    else:
        copies = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_copy"))
        salted = rows.withColumn("_turn", (F.monotonically_increasing_id() % SALTS).cast("int"))
        met = salted.join(copies, (F.col("_at") == F.col("_block")) & (F.col("_turn") == F.col("_copy")), "left")
    return met.select(*df.columns, (F.col(key).isNotNull() & F.coalesce(hit, F.lit(False))).alias(maybe))


def mirrors(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(url) of the pages whose title a page with a smaller id has too: a list that grows with the table.

    A null html, and an empty or no title, match nothing; of a null id nothing is known. A title on
    very many pages is met in SALTS copies."""
    titled = pages.select(F.col(id_col).alias("_id"), F.col(url).alias("url"),
                          F.regexp_extract(html, "<title>([^<]*)</title>", 1).alias("_title")).where("_title <> ''")
    first = titled.groupBy(F.col("_title").alias("_t")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where(
        "_n > 1").select("_t", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salted = titled.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
    return salted.join(first, (F.col("_title") == F.col("_t")) & (F.col("_salt") == F.col("_s"))).where(
        "_id > _first").select("url")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
               id_col: str = "page_id", url: str = "url", listed_url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, canonical_url) for every row of ``pages``."""
    exact = written(listed.select(canonical(F.col(listed_url)).alias("_listed")).where("_listed is not null").distinct(), "listed")
    log2 = log2_blocks(exact.count())
    base = pages.select(
        F.col(id_col), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        canonical(F.col(url)).alias("canonical_url"))
    host, path = F.col("host"), F.col("path")
    base = base.select("*", rule_column(rules, host, path, 0).alias("rule"),
                       rule_column(rules, host, path, 1).alias("_ruled"))
    flagged = with_maybe(base, "canonical_url", bloom_blocks(exact, "_listed", log2), log2=log2)
    open_ = F.col("rule").isNull() & F.col("_maybe")
    passed = flagged.where(~open_).select(
        *base.columns, F.coalesce("_ruled", F.lit("allow")).alias("verdict"))
    salted = flagged.where(open_).withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
    copies = exact.select("_listed", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    looked = salted.join(
        copies.hint("shuffle_hash"), (F.col("canonical_url") == F.col("_listed")) & (F.col("_salt") == F.col("_s")), "left"
    ).select(*base.columns, F.when(F.col("_listed").isNotNull(), "block").otherwise("allow").alias("verdict"))
    return passed.unionByName(looked).select(id_col, "host", "path", "rule", "verdict", "canonical_url")
