"""Operator 8: language identification by Bayesian evidence fusion.

Four pieces of evidence on a page's language are multiplied:

* the text: naive Bayes over hashed character trigrams, trained here on a
  bounded sample of labelled documents;
* the language that the markup declares, and the suffix of the address: how
  often each goes with each language, from grouped sums of the text posteriors;
* the host's prior: the sum of its other pages' text posteriors, smoothed
  towards its domain's, that towards the whole corpus's.

Defined results: a null or empty page has only its address as evidence; a null
address belongs to no host and takes the corpus's prior. Without any training
row there is no language, and the result has null. Ties go to the language
that sorts first. Rows are judged one by one; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcorpus.llm.common import in_slices, ship_by_value, written
from parcorpus.llm.urlfilter import host_of

BUCKETS = 1 << 14
#: Different labelled documents that the text model is fitted on, at most: those with the smallest hash.
SAMPLE_ROWS = 4000
#: Weight of one trigram: neighbours overlap, so they are not independent evidence.
TRIGRAM_WEIGHT = 0.2
#: Weight of the wider prior, in pages, for a host and for a domain.
HOST_WEIGHT, DOMAIN_WEIGHT = 5.0, 20.0
SMOOTH = 0.5


def trigrams(text: str):
    """Bucket numbers of the character trigrams of a text, lower-cased, digits and symbols as gaps."""
    import re

    import numpy as np

    s = re.sub(r"[\W\d_]+", " ", text.lower())
    c = np.frombuffer(f" {s} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) + c[1:-1]) * np.uint64(0xD6E8FEB86659FD93) + c[2:]
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(50)).astype(np.int64)


def page_text(html: str) -> str:
    """What a reader sees of a page's article: no markup, scripts, menus or advertisements."""
    import html as entities
    import re

    t = re.sub(r"(?is)<(script|style|nav)\b.*?</\1\s*>|<!--.*?-->|<div class=.ad.>.*?</div>", " ", html)
    return entities.unescape(re.sub(r"<[^>]*>", " ", t))


def nth_smallest(hashes: DataFrame, h: str, n: int) -> int | None:
    """The ``n``-th smallest of the distinct values of ``h`` (the largest, if there are fewer; null
    without any).

    Hashes are spread evenly, so a bound that about 2 n + 100 of them fall under is known from their
    number, and only those few are ranked."""
    distinct = hashes.agg(F.approx_count_distinct(h)).first()[0]
    share = (2 * n + 100) / max(distinct, 1)
    below = hashes.where(F.col(h) <= -(1 << 63) + int(share * 2.0 ** 64)) if share < 0.9 else hashes
    return below.select(h).distinct().orderBy(h).limit(n).agg(F.max(h)).first()[0]


def train(labelled: DataFrame, label: str, text: str, rows: int = SAMPLE_ROWS) -> tuple[list[str], list]:
    """(languages, log-likelihood per language and bucket) from ``rows`` different labelled rows.

    The sample's rows stay where they are, one of equal ones; counted in tasks and summed by Spark; the driver gets BUCKETS numbers per language."""
    known = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("lang"), F.col(text).alias("t")).withColumn("_h", F.xxhash64("t", "lang"))
    last = nth_smallest(written(known.select("_h"), "sample-hashes"), "_h", rows)
    sample = known.where(F.col("_h") <= F.lit(last)).groupBy("_h", "lang").agg(F.first("t").alias("t"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        counts: dict = {}
        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist()):
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(trigrams(t), minlength=BUCKETS)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(c[at])],
                                             ["lang", "bucket", "c"])

    import numpy as np

    sums = sample.mapInArrow(run, "lang string, bucket long, c long").groupBy("lang", "bucket").agg(
        F.sum("c").alias("c")).collect()
    languages = sorted({r["lang"] for r in sums})
    table = np.full((len(languages), BUCKETS), SMOOTH)
    for r in sums:
        table[languages.index(r["lang"]), r["bucket"]] += r["c"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def with_text_posterior(pages: DataFrame, html: str, languages: list[str], table, out: str = "_p") -> DataFrame:
    """Add the posterior of each language given the page's text alone, and the declared language."""
    held = pages.sparkSession.sparkContext.broadcast(table)
    names = pages.columns
    carried = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != html]

    def run(batches):
        import re

        import numpy as np
        import pyarrow as pa

        declared = re.compile(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})""")
        loglik = held.value
        for batch in batches:
            for part in in_slices(batch, html):
                said, post = [], []
                for page in part.column(html).to_pylist():
                    m = declared.search(page or "")
                    said.append(m[1].lower() if m else "")
                    at = trigrams(page_text(page or ""))
                    x = loglik[:, at].sum(axis=1) * TRIGRAM_WEIGHT
                    x = np.exp(x - x.max()) if len(x) else x
                    post.append((x / x.sum()).tolist() if len(x) else [])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names if c != html], pa.array(said, pa.string()),
                     pa.array(post, pa.list_(pa.float64()))], [*[c for c in names if c != html], "declared", out])

    return pages.mapInArrow(run, ", ".join([*carried, "declared string", f"{out} array<double>"]))


def fuse(seen: DataFrame, languages: list[str], url: str = "url") -> DataFrame:
    """Add ``lang``, ``confidence`` and ``text_lang`` to rows with a text posterior ``_p``."""
    n = len(languages)
    at = range(n)
    host = host_of(F.col(url))
    domain = F.array_join(F.slice(F.split("_host", "\\."), F.greatest(F.lit(1), F.size(F.split("_host", "\\.")) - 1), 2), ".")
    seen = seen.withColumn("_host", F.regexp_replace(host, ":[0-9]+$", "")).withColumn("_domain", domain).withColumn(
        "_suffix", F.substring_index("_domain", ".", -1))
    seen = written(seen, "page-posteriors")

    def sums(key: str, name: str, where: str = "true") -> DataFrame:
        return seen.where(where).groupBy(F.col(key).alias(f"_k_{name}")).agg(
            F.array(*[F.sum(F.get("_p", F.lit(k))) for k in at]).alias(name))

    total = seen.agg(*[F.sum(F.get("_p", F.lit(k))).alias(f"t{k}") for k in at]).first()
    mass = [float(total[k] or 0) + SMOOTH for k in at]
    corpus = F.array(*[F.lit(m / sum(mass)) for m in mass])
    df = seen
    for key, name in (("declared", "_s_declared"), ("_suffix", "_s_suffix"), ("_domain", "_s_domain"), ("_host", "_s_host")):
        where = "_host <> ''" if key in ("_domain", "_host") else "true"
        df = df.join(sums(key, name, where), F.col(key) == F.col(f"_k_{name}"), "left")

    def others(name: str, k: int) -> Column:
        """What the other rows of the group have for a language: this row has its own say in the text."""
        return F.greatest(F.coalesce(F.get(name, F.lit(k)) - F.get("_p", F.lit(k)), F.lit(0.0)), F.lit(0.0))

    def given(name: str, k: int) -> Column:
        """Share of a language's rows that are in the group."""
        return (others(name, k) + SMOOTH) / (mass[k] + 20 * SMOOTH)

    def smoothed(name: str, wider: Column, weight: float) -> Column:
        size = sum([others(name, k) for k in at[1:]], others(name, 0))
        return F.array(*[(others(name, k) + weight * F.get(wider, F.lit(k))) / (size + weight) for k in at])

    df = df.withColumn("_prior_domain", smoothed("_s_domain", corpus, DOMAIN_WEIGHT))
    df = df.withColumn("_prior_host", smoothed("_s_host", F.col("_prior_domain"), HOST_WEIGHT))
    score = [F.log(F.get("_p", F.lit(k)) + 1e-12) + F.log(given("_s_declared", k)) + F.log(given("_s_suffix", k)) +
             F.log(F.get("_prior_host", F.lit(k))) for k in at]
    df = df.withColumn("_score", F.array(*score)).withColumn("_top", F.array_max("_score"))
    weights = sum([F.exp(F.get("_score", F.lit(k)) - F.col("_top")) for k in at[1:]], F.exp(F.get("_score", F.lit(0)) - F.col("_top")))
    names = F.array(*[F.lit(x) for x in languages])
    best = lambda scores: F.get(names, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
    return df.select(*[c for c in seen.columns if not c.startswith("_")], best(F.col("_score")).alias("lang"),
                     (1 / weights).alias("confidence"), best(F.col("_p")).alias("text_lang"))


def identify(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
             label: str = "lang", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, url, declared, lang, confidence, text_lang) for every row of ``pages``."""
    languages, table = train(labelled, label, text, rows)
    pages = pages.select(id_col, url, html)
    if not languages:
        nothing = F.lit(None)
        return pages.select(id_col, url, nothing.cast("string").alias("declared"), nothing.cast("string").alias("lang"),
                            nothing.cast("double").alias("confidence"), nothing.cast("string").alias("text_lang"))
    return fuse(with_text_posterior(pages, html, languages, table), languages, url)


ship_by_value(__name__)
