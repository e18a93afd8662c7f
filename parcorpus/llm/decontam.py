"""Operator 5: benchmark decontamination by greedy string tiling.

Words are lower-cased and freed of ASCII punctuation. Karp-Rabin hashes of all
five-word runs of a document are joined with those of the benchmark items;
equal seeds along a diagonal form the maximal common matches. For each document
and item that share a seed, the longest match is marked as a tile again and
again, matches being cut back to their unmarked words, until none of five words
is left. The share of the item's words under tiles is its coverage: moving
sentences of the item around cuts it into more tiles, but leaves the coverage.

The documents are never shuffled. The benchmark is split by hash into blocks of
about ``BLOCK_WORDS`` words, and the documents are scanned once per block, so
what a task holds of the benchmark is bounded whatever its length.

Defined results: a null or empty text shares nothing; an item of fewer than
five words is never found. Rows are judged one by one, repeated rows alike;
equal items are reported each. An empty benchmark finds nothing. Other columns
are carried along and may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcorpus.llm.common import in_slices, ship_by_value, words
from parcorpus.llm.rolling import PUNCTUATION, SPACE, WordHasher, runs

SEED_WORDS = 5
MIN_COVERAGE = 0.5
#: Words of the benchmark that one scan of the documents takes along (some 30 MB in a task).
BLOCK_WORDS = 1_000_000

TILE = T.StructType([T.StructField(n, T.IntegerType()) for n in ("doc_word", "item_word", "words")])


def diagonal_matches(at, in_item, length: int) -> list[tuple[int, int, int]]:
    """Maximal matches (words, place in document, place in item) from the places
    of equal seeds of ``length`` words."""
    import numpy as np

    order = np.lexsort((at, at - in_item))
    a, b = at[order], in_item[order]
    new = np.flatnonzero(np.r_[True, (np.diff(a - b) != 0) | (np.diff(a) != 1)])
    size = np.diff(np.r_[new, len(a)]) + length - 1
    return list(zip(size.tolist(), a[new].tolist(), b[new].tolist()))


def tile(matches: list[tuple[int, int, int]], doc_words: int, item_words: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest match first, ties from the left; what is
    marked on either side cuts later matches into their unmarked stretches."""
    heap = [(-n, b, a) for n, a, b in matches]
    heapq.heapify(heap)
    in_doc, in_item, tiles = bytearray(doc_words), bytearray(item_words), []
    while heap:
        n, b, a = heapq.heappop(heap)
        n = -n
        free = bytes(x | y for x, y in zip(in_doc[a:a + n], in_item[b:b + n]))
        if not any(free):
            tiles.append((a, b, n))
            in_doc[a:a + n] = in_item[b:b + n] = b"\1" * n
            continue
        k = 0
        for stretch in free.split(b"\1"):
            if len(stretch) >= least:
                heapq.heappush(heap, (-len(stretch), b + k, a + k))
            k += len(stretch) + 1
    return sorted(tiles)


class Seeds:
    """The five-word runs of a block of benchmark items, ready for look-ups."""

    def __init__(self, items: list[tuple[int, str]], seed: int):
        import numpy as np
        import pyarrow as pa

        self.seed, self.hasher = seed, WordHasher(SPACE + PUNCTUATION)
        h, first = self.hasher.words(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.size = np.diff(first)
        grams = runs(h, seed)
        own = np.searchsorted(first, np.arange(len(grams)), "right") - 1
        whole = np.arange(len(grams)) + seed <= first[1:][own] if len(grams) else np.zeros(0, bool)
        place = (np.arange(len(grams)) - first[:-1][own])[whole] if len(grams) else np.zeros(0, np.int64)
        grams, own = grams[whole], own[whole]
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.place = grams[order], own[order], place[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.grams & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def found(self, column, least: float):
        """Yield (row, item, coverage, tiles) for the texts of an Arrow column."""
        import numpy as np

        h, first = self.hasher.words(column)
        grams = runs(h, self.seed)
        if not len(grams) or not len(self.grams):
            return
        at = np.flatnonzero(self.seen[(grams & np.uint64((1 << 22) - 1)).astype(np.int64)])
        lo = np.searchsorted(self.grams, grams[at], "left")
        hi = np.searchsorted(self.grams, grams[at], "right")
        row = np.searchsorted(first, at, "right") - 1
        hit = (hi > lo) & (at + self.seed <= first[1:][row])
        at, lo, hi, row = at[hit], lo[hit], hi[hit], row[hit]
        for r in np.unique(row).tolist():
            of = row == r
            n = (hi - lo)[of]
            a = np.repeat(at[of] - first[r], n)
            k = np.repeat(lo[of], n) + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            item = self.item[k]
            for i in np.unique(item).tolist():
                mine = item == i
                size = int(self.size[i])
                # the seeds' union bounds the coverage: skip items that cannot reach the threshold
                under = np.zeros(size + self.seed, bool)
                for j in range(self.seed):
                    under[self.place[k[mine]] + j] = True
                if under.sum() < least * size:
                    continue
                tiles = tile(diagonal_matches(a[mine], self.place[k[mine]], self.seed),
                             int(first[r + 1] - first[r]), size, self.seed)
                covered = sum(t[2] for t in tiles)
                if covered >= least * size:
                    yield r, i, covered / size, tiles


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple]]:
    """The benchmark's blocks, each of about ``block_words`` words (more only for one longer item)."""
    items = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).alias("i"), F.col(text).alias("t"))
    total = items.agg(F.sum(F.size(words(F.col("t"))))).first()[0] or 0
    n = 1 + total // block_words
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], r["t"]) for r in block.collect()]


def find_contaminated(docs: DataFrame, benchmark: DataFrame, columns: list[str], text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", min_coverage: float = MIN_COVERAGE,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs`` and item covered to ``min_coverage`` or more:
    the ``columns`` of the row, ``item_id``, ``coverage`` and ``tiles``."""
    fields = {f.name: f for f in docs.schema.fields}
    kind = benchmark.schema[item_id].dataType
    result = {"item_id", "coverage", "tiles"}
    columns = [c for c in columns if c.lower() not in result]
    schema = T.StructType([*[fields[c] for c in columns], T.StructField("item_id", kind),
                           T.StructField("coverage", T.DoubleType()), T.StructField("tiles", T.ArrayType(TILE))])
    packed = docs.select(*columns, F.col(text).alias("_text"))
    out = None
    for block in benchmark_blocks(benchmark, item_id, item_text, block_words):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held):
            import pyarrow as pa

            seeds = Seeds(held.value, SEED_WORDS)
            names = schema.names
            for batch in batches:
                for part in in_slices(batch, "_text", 1 << 20):
                    got = list(seeds.found(part.column("_text"), min_coverage))
                    if not got:
                        continue
                    rows = pa.array([g[0] for g in got], pa.int64())
                    arrays = [part.column(c).take(rows) for c in columns]
                    arrays.append(pa.array([seeds.ids[g[1]] for g in got], id_type(pa)))
                    arrays.append(pa.array([g[2] for g in got], pa.float64()))
                    arrays.append(pa.array([[dict(zip(("doc_word", "item_word", "words"), t)) for t in g[3]]
                                            for g in got], tile_type(pa)))
                    yield pa.RecordBatch.from_arrays(arrays, names)

        def tile_type(pa):
            return pa.list_(pa.struct([(n, pa.int32()) for n in ("doc_word", "item_word", "words")]))

        def id_type(pa):
            return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]

        found = packed.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", min_coverage: float = MIN_COVERAGE,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that cover no item of the benchmark, unchanged."""
    for block in benchmark_blocks(benchmark, item_id, item_text, block_words):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held):
            import numpy as np
            import pyarrow as pa

            seeds = Seeds(held.value, SEED_WORDS)
            for batch in batches:
                for part in in_slices(batch, text, 1 << 20):
                    clean = np.ones(part.num_rows, bool)
                    clean[[g[0] for g in seeds.found(part.column(text), min_coverage)]] = False
                    yield part if clean.all() else part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


ship_by_value(__name__)
