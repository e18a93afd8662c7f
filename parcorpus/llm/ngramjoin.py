"""Operator 10: n-gram Jaccard self-join over a count-vector R-tree.

A document's set holds the 64-bit hashes of its 4-word shingles. The shingles
are hashed into groups; the group counts are the document's point, and the sum
of coordinate minima bounds the overlap of two sets, or of two boxes of points.
The counts of a finer grouping are kept modulo 2, as bits: two sets differ in
at least as many shingles as these bits, which tells near misses apart. The
number of bits grows with the set, or they would tell nothing about long texts.

One tree over all points cannot prune: in so many dimensions every box meets
every other. So the index is parted first, without loss. Two linked sets differ
in at most r shingles (r follows from the sizes), so if shingles are dealt into
more than r parts, some part holds the same shingles in both. A document enters
the buckets of its r + 1 fullest parts only: the order is the same for all, so two
linked documents still meet, and a passage that unrelated documents share rarely
fills such a part. In a bucket

1. each document is tried with the bucket's middle one (:func:`with_heads`):
   bound by the points, then verified exactly; large families of near copies
   are joined here, in linear time;
2. buckets that this leaves in several components get an R-tree: points sorted
   by size and counts are packed into leaves with bounding boxes, leaves are
   joined where their boxes allow a link, points where theirs do, and the
   surviving pairs are verified.

Links become components. Equal sets are one class from the start.

Defined results: a null or blank text has an empty set and is linked with
nothing; fewer than four words are one shingle. Repeated rows and equal texts
share a class. Null ids take part; a component's id is the smallest id that is
not null. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcorpus.llm.common import discard, in_slices, ship_by_value, written
from parcorpus.llm.graph import components
from parcorpus.llm.rolling import SPACE, WordHasher, mixed, runs
from parcorpus.llm.urlfilter import bloom_blocks, log2_blocks, with_maybe

SHINGLE = 4
#: Links have 100 * |A and B| >= PERCENT * |A or B|.
PERCENT = 85
#: Groups of the count vector: the dimensions of a point.
GROUPS = 64
#: Groups whose counts are kept modulo 2.
PARITIES = 1024
#: Words of 64 parities that a pair first carries: those of PARITIES, folded.
COARSE = 4
LEAF = 256
#: Buckets of a document by which a pair's later meetings are told.
FIRST = 12
#: Document sizes are banded by this ratio; every band has its own number of parts.
BAND = 1.6


def bands(percent: int) -> list[tuple[int, int, int]]:
    """(smallest size, largest difference r, parts) per size band.

    With a <= b < next band and 100 i >= percent (a + b - i), the difference a + b - 2 i is at
    most (a + b) (100 - percent) / (100 + percent). Twice as many parts leave more than
    r parts of several shingles in most sets."""
    out, low = [], 1
    while low < 1 << 40:
        high = max(low + 1, int(low * BAND))
        r = 2 * (high - 1) * (100 - percent) // (100 + percent)
        out.append((low, r, 2 * r + 5))
        low = high
    return out


class Shingler:
    """Sets, fingerprints, signatures and points of the texts of Arrow columns."""

    def __init__(self, shingle: int, percent: int):
        import numpy as np

        self.hasher, self.shingle, self.percent = WordHasher(SPACE), shingle, percent
        self.bands = bands(percent)
        self.lows = np.array([b[0] for b in self.bands])

    def sets(self, column):
        """Yield the sorted distinct shingle hashes of every text."""
        import numpy as np

        h, first = self.hasher.words(column)
        grams = runs(h, self.shingle)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= self.shingle:
                yield np.unique(grams[a:b - self.shingle + 1])
            else:
                yield runs(h[a:b], b - a) if b > a else grams[:0]

    def fingerprint(self, s) -> tuple[int, int]:
        import numpy as np

        one, two = mixed(s), mixed(s ^ np.uint64(0xA0761D6478BD642F))
        return int(one.sum(dtype=np.uint64).astype(np.int64)), int(two.sum(dtype=np.uint64).astype(np.int64))

    def point(self, s):
        import numpy as np

        return np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=GROUPS).astype(np.int32)

    def parity(self, s):
        return self.odd(s, PARITIES)

    def finer(self, s):
        """More parities for a larger set: as many as shingles, up to a power of two."""
        return self.odd(s, 1 << (len(s) - 1).bit_length()) if len(s) > PARITIES else s[:0].astype("int64")

    def odd(self, s, bits: int):
        import numpy as np

        odd = np.bincount((mixed(s) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)

    def signatures(self, s):
        """Hashes of (band, part, shingles in the part), for the set's own band
        and, if a linked set can be in the next one, for that.

        The set differs from a linked one in at most r shingles, hence in at most r parts. Of
        all parts, also the empty ones, the first r + 1 in one order for all sets are given:
        fullest first, then by hash. If two such prefixes had no part in common, all
        r + 1 of the one that ends first would be missing from the other set."""
        import numpy as np

        n = len(s)
        if not n:
            return np.zeros(0, np.int64)
        level = int(np.searchsorted(self.lows, n, "right")) - 1
        found = []
        for k in (level, level + 1):
            (low, _, parts), above = self.bands[k], self.bands[k + 1][0]
            largest = min(above - 1, 100 * n // self.percent)
            r = (n + largest) * (100 - self.percent) // (100 + self.percent)
            if largest < low or not r:
                continue  # out of reach, or only equal sets are near enough
            part = ((s >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])  # s is sorted, and so are the parts
            label, sums, full = part[cut], np.add.reduceat(mixed(s), cut), np.diff(np.r_[cut, n])
            if len(cut) <= r:
                empty = np.setdiff1d(np.arange(parts), label)
                label, sums, full = (np.r_[x, y] for x, y in (
                    (label, empty), (sums, np.zeros(len(empty), np.uint64)), (full, np.zeros(len(empty), np.int64))))
            hashes = mixed(sums + mixed((label + (k << 48)).astype(np.uint64))) >> np.uint64(8)
            order = (np.uint64(255) - np.minimum(full, 255).astype(np.uint64) << np.uint64(56)) | hashes
            found.append(np.partition(order, r)[:r + 1])
        return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


SIGNED = "n long, f1 long, f2 long, signatures array<long>"
MEASURED = "n long, f1 long, f2 long, hashes array<long>, point array<int>, parity array<long>, finer array<long>"


def _shingled(docs: DataFrame, text: str, carry: list[str], schema: str, full: bool,
              shingle: int, percent: int) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa

        make = Shingler(shingle, percent)
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for part in in_slices(batch, text, 1 << 20):
                n, f1, f2, arrays, points, odd, more = [], [], [], [], [], [], []
                for s in make.sets(part.column(text)):
                    a, b = make.fingerprint(s)
                    n.append(len(s))
                    f1.append(a)
                    f2.append(b)
                    arrays.append(s.astype(np.int64) if full else make.signatures(s))
                    if full:
                        points.append(make.point(s))
                        odd.append(make.parity(s))
                        more.append(make.finer(s))
                columns = [*[part.column(c) for c in carry], *[pa.array(x, pa.int64()) for x in (n, f1, f2)]]
                for values in (arrays, points, odd, more) if full else (arrays,):
                    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, np.concatenate(values)))
                yield pa.RecordBatch.from_arrays(columns, [*carry, *names])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return docs.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in carry], schema]))


def _minima(a: str, b: str) -> Column:
    """The sum of coordinate minima of two points."""
    parts = [F.least(F.get(a, F.lit(k)), F.get(b, F.lit(k))) for k in range(GROUPS)]
    return sum(parts[1:], parts[0])


def _may_link(overlap: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """100 i >= percent (a + b - i), for the overlap i or a bound of it."""
    return (100 + percent) * overlap >= percent * (n_a + n_b)


def _parities_allow(percent: int) -> Column:
    """Whether the parities of the sides ``_a`` and ``_b`` allow a link."""
    odd = [F.bit_count(F.get("parity_a", F.lit(k)).bitwiseXOR(F.get("parity_b", F.lit(k)))) for k in range(PARITIES // 64)]
    differ = sum(odd[1:], odd[0])
    return (100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))


def _points_allow(percent: int) -> Column:
    """Whether the points and parities of the sides ``_a`` and ``_b`` allow a link."""
    return _parities_allow(percent) & _may_link(_minima("point_a", "point_b"), F.col("n_a"), F.col("n_b"), percent)


def _finer_allow(percent: int) -> Column:
    """Whether the ``finer`` parities of the sides allow a link. Of two lengths the longer is folded
    to the shorter; a set with few shingles has none, then nothing is told."""
    shorter = F.least(F.size("finer_a"), F.size("finer_b"))
    one, two = (F.when(F.size(c) == shorter, F.col(c)).otherwise(F.zip_with(
        F.slice(c, F.lit(1), shorter), F.slice(c, shorter + 1, shorter), Column.bitwiseXOR)) for c in ("finer_a", "finer_b"))
    differ = F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    told = (shorter > 0) & (F.greatest(F.size("finer_a"), F.size("finer_b")) <= 2 * shorter)
    return ~told | ((100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b")))


def _sides(sets: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """``sets`` as the sides ``_a`` and ``_b`` of a pair, with the named columns."""
    return tuple(sets.select(*[F.col(c).alias(f"{c}_{x}") for c in ("rid", *columns)]) for x in "ab")


def _paired(pairs: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    return pairs.join(one, F.col("a") == F.col("rid_a")).join(two, F.col("b") == F.col("rid_b"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` that are links: bound by few bits first, then by the points, then the
    sets compared. Each pair carries what its step needs: 32 bytes a side, 400 and up to two bits a
    shingle, and the set."""
    words = PARITIES // 64
    folded = [F.array(*[reduce(Column.bitwiseXOR, [F.get("parity", F.lit(k)) for k in range(j, words, COARSE)])
                        for j in range(COARSE)]).alias("coarse")]
    one, two = _sides(sets.select("rid", "n", *folded), "n", "coarse")
    differ = [F.bit_count(F.get("coarse_a", F.lit(k)).bitwiseXOR(F.get("coarse_b", F.lit(k)))) for k in range(COARSE)]
    close = written(_paired(pairs, one, two).where(
        (100 + percent) * sum(differ[1:], differ[0]) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "close")
    one, two = _sides(sets, "n", "point", "parity", "finer")
    near = written(_paired(close, one, two).where(_points_allow(percent) & _finer_allow(percent)).select("a", "b"), "near")
    discard(close)
    # only sets of a pair that is left are dealt out; a Bloom filter tells them without moving the others
    asked = near.select(F.col("a").alias("_k")).unionByName(near.select(F.col("b").alias("_k"))).distinct()
    log2 = log2_blocks(min(2 * near.count(), sets.count()))
    needed = with_maybe(sets.select("rid", "n", "hashes"), "rid", bloom_blocks(asked, "_k", log2), log2=log2).where("_maybe")
    one, two = _sides(needed, "n", "hashes")
    overlap = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return _paired(near, one, two).where(_may_link(overlap, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def tree_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that one R-tree per bucket leaves.

    ``members``: (sig, rid, root, n, point, parity). Leaves are runs of the bucket's
    points in order of size and counts; a pair is given only where the boxes
    of its leaves, and then its parities, allow a link (a join's condition that also summed up the
    minima of two points would be too long to be compiled; :func:`verified` sums them next). Two documents share up to as
    many buckets as they have parts; a pair is passed over in a bucket if it
    is known to share an earlier one, that is one of the first FIRST of both."""
    first = members.groupBy(F.col("rid").alias("_of")).agg(F.slice(F.sort_array(F.collect_list("sig")), 1, FIRST).alias("_first"))
    members = members.join(first, F.col("rid") == F.col("_of")).select(
        *members.columns, F.filter("_first", lambda s: s < F.col("sig")).alias("before"))
    order = Window.partitionBy("sig").orderBy("n", "point", "rid")
    packed = written(members.withColumn("_k", F.row_number().over(order)).withColumn(
        "leaf", F.expr(f"(_k - 1) div {LEAF}")).drop("_k"), "leaves")
    boxes = packed.groupBy("sig", "leaf").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("root").alias("r0"), F.max("root").alias("r1"),
        *[F.max(F.get("point", F.lit(k))).alias(f"m{k}") for k in range(GROUPS)]).select(
        "sig", "leaf", "least", "most", "r0", "r1", F.array(*[f"m{k}" for k in range(GROUPS)]).alias("box"))
    x, y = (boxes.select(F.col("sig").alias(f"sig_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in boxes.columns[1:]]) for s in "xy")
    same = (F.col("r0_x") == F.col("r1_y")) & (F.col("r1_x") == F.col("r0_y")) & (F.col("r0_x") == F.col("r1_x"))
    nodes = x.join(y, (F.col("sig_x") == F.col("sig_y")) & (F.col("leaf_x") <= F.col("leaf_y")) & ~same & (
        100 * F.col("most_x") >= percent * F.col("least_y")) & _may_link(
        _minima("box_x", "box_y"), F.col("least_x"), F.col("least_y"), percent)).select("sig_x", "leaf_x", "leaf_y")
    a, b = (packed.select(*[F.col(c).alias(f"{c}_{s}") for c in packed.columns if c != "point"]) for s in "ab")
    left = nodes.join(a, (F.col("sig_x") == F.col("sig_a")) & (F.col("leaf_x") == F.col("leaf_a")))
    return left.join(b, (F.col("sig_x") == F.col("sig_b")) & (F.col("leaf_y") == F.col("leaf_b")) & (
        F.col("root_a") != F.col("root_b")) & ((F.col("leaf_x") != F.col("leaf_y")) | (F.col("rid_a") < F.col("rid_b"))) &
        _parities_allow(percent) & ~F.arrays_overlap("before_a", "before_b")).select(
        F.least("rid_a", "rid_b").alias("a"), F.greatest("rid_a", "rid_b").alias("b")).distinct()


def with_heads(shared: DataFrame) -> DataFrame:
    """(sig, rid, head) of the rows (sig, rid, size) of buckets.

    A bucket's head is the member that meets others most often in all its buckets, the smallest of
    several. Sets that have more parts in common are nearer, so this is the middle of a family: of
    copies that were each changed a little, the one changed least, to which more of the others are
    linked than to any other. Two grouped sums, of which a bucket or member is one row per task."""
    often = shared.groupBy(F.col("rid").alias("_of")).agg(F.sum(F.col("size") - 1).alias("often"))
    ranked = shared.join(often, F.col("rid") == F.col("_of")).select("sig", "rid", "often")
    heads = ranked.groupBy(F.col("sig").alias("_sig")).agg(
        F.max(F.struct("often", (-F.col("rid")).alias("less"))).alias("_head"))
    return shared.join(heads, F.col("sig") == F.col("_sig")).select("sig", "rid", (-F.col("_head.less")).alias("head"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                      percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``."""
    base = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).withColumn("_h", F.xxhash64("_text"))
    signed = written(_shingled(base, "_text", ["_id", "_h"], SIGNED, False, shingle, percent), "signed")
    # equal sets are one class from here on: a text on a third of all rows is one row per task
    classes = signed.where("n > 0").groupBy("n", "f1", "f2").agg(
        F.min("_h").alias("_h"), F.first("signatures").alias("signatures"))
    signed_classes = written(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")
    rows = written(signed.drop("signatures", "_h"), "rows")
    discard(signed)
    shared = written(signed_classes.select("rid", F.explode("signatures").alias("sig")).repartition("sig").select(
        "sig", "rid", F.count(F.lit(1)).over(Window.partitionBy("sig")).alias("size")).where("size > 1"), "shared")
    met = written(with_heads(shared), "buckets")
    discard(shared)
    classes = written(signed_classes.drop("signatures"), "classes")
    discard(signed_classes)
    # the sets of documents that met another; a Bloom filter keeps the other texts from being read twice
    wanted = classes.join(met.select("rid").distinct(), "rid", "left_semi").select("rid", "n", "f1", "f2", "_h")
    log2 = log2_blocks(classes.count())
    texts = with_maybe(base.select("_text", "_h"), "_h", bloom_blocks(wanted, "_h", log2), log2=log2).where("_maybe").select("_text")
    sets = _shingled(texts, "_text", [], MEASURED, True, shingle, percent).groupBy("n", "f1", "f2").agg(
        *[F.first(c).alias(c) for c in ("hashes", "point", "parity", "finer")])
    sets = written(sets.join(wanted.drop("_h"), ["n", "f1", "f2"]).select("rid", "n", "point", "parity", "finer", "hashes"), "sets")
    tried = met.where("rid <> head").select(F.col("head").alias("a"), F.col("rid").alias("b")).distinct()
    links = written(verified(tried, sets, percent), "links")
    joined = components(links, "a", "b")
    # buckets that are still in several components
    rooted = met.select("sig", "rid").join(joined, F.col("rid") == F.col("node"), "left").select(
        "sig", "rid", F.coalesce("root", "rid").alias("root"))
    open_ = rooted.groupBy("sig").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b").select("sig")
    members = rooted.join(open_, "sig", "left_semi").join(sets.select("rid", "n", "point", "parity"), "rid")
    left = written(tree_pairs(members, percent), "tree-pairs")
    more = written(verified(left, sets, percent), "links")
    joined = written(components(links.unionByName(more), "a", "b"), "components")
    discard(sets, met)
    named = rows.join(
        classes.select(*[F.col(c).alias(f"_{c}") for c in ("n", "f1", "f2", "rid")]),
        (F.col("n") == F.col("_n")) & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2")), "left"
    ).join(joined, F.col("_rid") == F.col("node"), "left").select(
        "_id", "n", F.coalesce("root", "_rid").alias("_root"))
    named = written(named, "named")
    least = named.where("_root is not null").groupBy(F.col("_root").alias("_r")).agg(F.min("_id").alias("_least"))
    return named.join(least, F.col("_root") == F.col("_r"), "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("_root").isNull(), F.col("_id")).otherwise(F.col("_least")).alias("component_id"))


ship_by_value(__name__)
