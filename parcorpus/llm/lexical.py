"""Operator 13: ranked lexical search by NRA (no random access).

One scan of the documents finds the postings (document, term, occurrences) of the
items' terms, with the counts of documents and of all terms. The frequencies of
the terms follow from the postings, and with them each posting's impact on a
score. Postings are dealt by document into shards. In a shard every term's list
is sorted by impact, and each item reads the lists of its terms from the top,
all to growing depths, with no look-up of a single document. What it has read of
a document bounds its score from below; adding, for every list in which the
document was not met, the impact at which that list stands, bounds it from above.
It reads on until no other document can enter the best ``k`` or tie with them, and
until the bounds of these ``k`` meet. The shards' best are ranked together.

The items are taken in blocks of about ``BLOCK_TERMS`` terms, one after the
other, so that what the driver and a task hold of them is bounded. Words are
found by 64-bit hashes and then compared byte by byte.

Defined results: a null, empty or term-free text counts as no document; an item
without terms, or of terms that no document holds, has no rows. Repeated items
and documents are rows of their own. Equal scores go by the smaller id, null ids
last; documents with a score of 0 are not listed. Very long texts are read whole,
one at a time beside the rest of a batch. Empty tables give no rows. Ids of
documents are whole numbers, those of items of any kind; other columns are
ignored and may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcorpus.llm.common import ascii_lower, discard, in_slices, ship_by_value, written
from parcorpus.llm.rolling import PUNCTUATION, WordHasher

#: Fixed value: a term, in lower-cased text.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Distinct (item, term) pairs of one scan (some 60 MB in a task), postings of one shard (some 100 MB).
BLOCK_TERMS, SHARD_POSTINGS = 200_000, 1_500_000
#: Postings that an item first reads of each list; every round reads twice as many as the one before.
DEPTH = 64

POSTED = "part long, n_docs long, n_terms long, ids array<long>, sizes array<long>, doc array<int>, term array<int>, tf array<int>"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(size: int, n_docs: int, n_terms: int) -> int:
    return 100 - 75 + 75 * size * n_docs // n_terms


class Finder:
    """Finds a list of terms in the texts of Arrow columns."""

    def __init__(self, wanted: list[str]):
        import numpy as np
        import pyarrow as pa

        self.hasher = WordHasher(PUNCTUATION)
        h, _ = self.hasher.words(pa.array(wanted, pa.string()))
        self.order = np.argsort(h, kind="stable")
        self.hashes = h[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms have one hash")
        spelt = [wanted[k].encode() for k in self.order]
        self.length = np.array([len(w) for w in spelt], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelt), np.uint8)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def found(self, column):
        """(words of each text, rows, terms, occurrences): each row and term that it holds once."""
        import numpy as np

        h, first, data, s, e = self.hasher.located(column)
        sizes = np.diff(first)
        at = np.flatnonzero(self.seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = (self.hashes[k] == h[at]) & (e[at] - s[at] + 1 == self.length[k])
        at, k = at[hit], k[hit]
        # compare the bytes, A-Z lower-cased, of all words found at once
        n = self.length[k]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        text = data[np.repeat(s[at], n) + inside]
        text = np.where((text >= 65) & (text <= 90), text + 32, text)
        wrong = text != self.bytes[np.repeat(self.begin[k], n) + inside]
        if wrong.any():
            hit = np.ones(len(at), bool)
            hit[np.repeat(np.arange(len(at)), n)[wrong]] = False
            at, k = at[hit], k[hit]
        row = np.searchsorted(first, at, "right") - 1
        pairs, tf = np.unique(row * len(self.hashes) + k, return_counts=True)
        return sizes, pairs // len(self.hashes), self.order[pairs % len(self.hashes)], tf


def postings(docs: DataFrame, id_col: str, text: str, wanted: list[str]) -> DataFrame:
    """Postings (POSTED) of the terms ``wanted``, packed by slices of the documents."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def lists(values, kind):
            values = np.asarray(values)
            return pa.ListArray.from_arrays(np.array([0, len(values)], np.int32), pa.array(values, kind))

        finder = Finder(held.value)
        for batch in batches:
            for part in in_slices(batch, "_text", 1 << 20):
                sizes, row, term, tf = finder.found(part.column("_text"))
                own, doc = np.unique(row, return_inverse=True)
                ids = part.column("_id").take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(row)], pa.int64()), pa.array([int((sizes > 0).sum())], pa.int64()),
                    pa.array([int(sizes.sum())], pa.int64()), pa.ListArray.from_arrays(np.array([0, len(own)], np.int32), ids),
                    lists(sizes[own], pa.int64()), lists(doc, pa.int32()), lists(term, pa.int32()), lists(tf, pa.int32())],
                    ["n_postings", *[f.split()[0] for f in POSTED.split(", ")][1:]])

    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text"))
    return own.mapInArrow(run, POSTED.replace("part long", "n_postings long")).withColumn("part", F.monotonically_increasing_id())


class Lists:
    """The impact-sorted lists of a shard."""

    def __init__(self, sizes, doc, term, tf, weights, n_docs: int, n_terms: int):
        import numpy as np

        self.docs = len(sizes)
        kinds, of = np.unique(sizes, return_inverse=True)
        m = np.array([length_factor(n, n_docs, n_terms) for n in kinds.tolist()], np.int64)[of]
        tf = tf.astype(np.int64)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        cut = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        ends = np.r_[cut[1:], len(term)]
        self.range = {int(term[a]): (int(a), int(b)) for a, b in zip(cut, ends) if self.impact[a] > 0}

    def best(self, query: list[tuple[int, int]], k: int, rank_of):
        """(documents, scores) of the best ``k`` for the (term, times) of ``query``; ``rank_of``: the documents' order of ids."""
        import numpy as np

        lists = [(*self.range[t], times) for t, times in query if t in self.range]
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = np.zeros(self.docs, np.int64)
        met = np.zeros((self.docs, len(lists)), bool)
        at = [a for a, _, _ in lists]
        depth = DEPTH
        live = None  # those that may be among the best, once no others will be met
        while True:
            bounds = np.zeros(len(lists), np.int64)
            for j, (_, end, times) in enumerate(lists):
                here = slice(at[j], min(at[j] + depth, end))
                docs = self.doc[here]
                low[docs] += times * self.impact[here]
                met[docs, j] = True
                at[j] = here.stop
                if here.stop < end:
                    bounds[j] = times * self.impact[here.stop]
            depth *= 2
            if live is None:
                live = np.flatnonzero(low)
            own = low[live]
            high = own + (~met[live]) @ bounds if bounds.any() else own
            if len(live) > k:
                kth = np.partition(own, len(own) - k)[len(own) - k]
                keep = high >= kth
                live, own, high = live[keep], own[keep], high[keep]
                unseen = int(bounds.sum()) >= kth  # a document not met yet may still enter or tie
            else:
                unseen = bool(bounds.any())
            if not unseen and (own == high).all():
                order = np.lexsort((rank_of[live], -own))[:k]
                return live[order], own[order]
            if unseen:
                live = None


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, id, score): the ``k`` documents of the highest score above 0 for every item."""
    asked = written(items.select(F.monotonically_increasing_id().alias("_item"), F.col(item_id).alias("_name"),
                                 terms(F.col(item_text)).alias("_terms")), "items")
    used = written(asked.select("_item", F.explode("_terms").alias("term")).groupBy("_item", "term").agg(
        F.count(F.lit(1)).alias("times")), "item-terms")
    blocks = 1 + used.count() // BLOCK_TERMS
    done, result = [], None
    for b in range(blocks):
        block = used.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == b).collect()
        best = written(_best_of(docs, block, k, id_col, text), "best")
        done.append(best)
        result = best if result is None else result.unionByName(best)
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = written(result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(
        asked.select("_item", "_name"), "_item").select(F.col("_name").alias(item_id), "rank", F.col("id").alias(id_col), "score"),
        "ranked")
    discard(asked, used, *done)
    return ranked


def _best_of(docs: DataFrame, block: list, k: int, id_col: str, text: str) -> DataFrame:
    """(_item, id, score): the best ``k`` of every shard for the items of a block."""
    spark = docs.sparkSession
    wanted = sorted({r["term"] for r in block})
    if not wanted:
        return spark.createDataFrame([], "_item long, id long, score long")
    number = {t: i for i, t in enumerate(wanted)}
    queries: dict[int, list] = {}
    for r in block:
        queries.setdefault(r["_item"], []).append((number[r["term"]], r["times"]))
    posted = written(postings(docs, id_col, text, wanted), "postings")
    n_docs, n_terms, n_postings = posted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_docs", "n_terms", "n_postings")]).first()
    # a row per term of the block at most
    counts = posted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    df = {r["term"]: r["df"] for r in counts}
    held = spark.sparkContext.broadcast((queries, [weight(n_docs, df.get(i, 0)) for i in range(len(wanted))]))

    def search(shard):
        import numpy as np
        import pyarrow as pa

        queries, weights = held.value
        kinds = pa.schema([("_item", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
        parts = {c: shard.column(c).combine_chunks() for c in ("ids", "sizes", "doc", "term", "tf")}
        flat = {c: parts[c].flatten() for c in parts}
        docs_of = np.diff(parts["ids"].offsets.to_numpy())
        doc = flat["doc"].to_numpy() + np.repeat(np.cumsum(docs_of) - docs_of, np.diff(parts["doc"].offsets.to_numpy()))
        lists = Lists(flat["sizes"].to_numpy(), doc, flat["term"].to_numpy(), flat["tf"].to_numpy(),
                      np.array(weights, np.int64), n_docs, n_terms)
        order = pa.compute.sort_indices(flat["ids"], null_placement="at_end").to_numpy()
        rank_of = np.empty(len(order), np.int64)
        rank_of[order] = np.arange(len(order))
        found = [(item, *lists.best(query, k, rank_of)) for item, query in queries.items()]
        at = np.concatenate([f[1] for f in found])
        return pa.table([np.repeat([f[0] for f in found], [len(f[1]) for f in found]),
                         flat["ids"].take(pa.array(at, pa.int64())), np.concatenate([f[2] for f in found])], schema=kinds)

    shards = 1 + n_postings // SHARD_POSTINGS
    best = posted.withColumn("_shard", F.pmod(F.xxhash64("part"), F.lit(shards))).groupBy("_shard").applyInArrow(
        search, "_item long, id long, score long")
    best = written(best, "shard-best")
    discard(posted)
    return best


ship_by_value(__name__)
