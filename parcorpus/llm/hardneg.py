"""Operator 11: hard-negative mining by Kronecker-packed products.

Vectors become whole numbers: component x is floor(scale * x). The rows are
dealt into groups of about ``GROUP`` rows, the anchors into groups of about
``ANCHORS``; each pair of groups meets in one task, by an equi-join on the
pair's number. There ``FIELDS`` candidates at a time become wide integers, one
per dimension: each candidate's component, made non-negative by a bias, stands
in a field of its own. An anchor multiplies each of these integers once by its
own (biased) component and adds the products. The fields are as wide as the
largest possible sum, so none runs over into the next: taken apart and freed of
the bias, they hold the exact inner products of the anchor with all candidates.

Two passes over the same pairs of groups: the first keeps each anchor's best
rows of its own label, the second its best rows of other labels between the
bounds that each positive's score sets. A pair of groups hands on at most
``positives`` rows an anchor, and ``negatives`` rows an anchor and positive.

Defined results: a row with a null label, a null vector, or a null or
non-finite component takes no part. A row with a null id is no anchor and comes
after all others of its score. Repeated rows are rows of their own: a copy of
the anchor is another row. Of rows with one score and id, that read first comes
first. Missing components of a shorter vector count as 0; empty vectors score 0.
A negative positive score has bounds that nothing satisfies. Scores are exact
at any size; one that does not fit in 64 bits is reported as the nearest number
that does. An empty table, or one without anchors, gives no rows. Other columns
are ignored and may have any name. Texts play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcorpus.llm.common import discard, ship_by_value, written

#: Rows and anchors of one task (some 8 MB of vectors of 64 components), candidates of one wide integer.
GROUP, ANCHORS, FIELDS = 8192, 1024, 4096
TOP = 2 ** 63 - 1


def quantised(x: Column, scale: int) -> Column:
    return F.floor(x.cast("double") * F.lit(float(scale)))


class Packed:
    """The vectors of a group of candidates as wide integers, for exact products."""

    def __init__(self, q, largest: int, least: int):
        """``q``: candidates x dimensions; ``largest`` and ``least``: bounds of an anchor's components."""
        import numpy as np

        self.n, self.dims = q.shape
        self.bias = -min(0, int(q.min())) if q.size else 0
        self.shift = -min(0, least)
        most = self.dims * ((int(q.max()) if q.size else 0) + self.bias) * (max(0, largest) + self.shift)
        self.width = max(1, (most.bit_length() + 7) // 8)  # bytes of a field
        self.sums = [int(s) for s in q.sum(axis=1, dtype=object)] if self.width > 7 else q.sum(axis=1)
        self.parts = []
        for k in range(0, self.n, FIELDS):
            part = q[k:k + FIELDS]
            wide = np.zeros((self.dims, len(part), self.width), np.uint8)
            biased = (part.T.astype(object) + self.bias) if self.width > 7 else (part.T + self.bias)
            if self.width > 7:
                for d in range(self.dims):
                    wide[d] = np.frombuffer(b"".join(int(x).to_bytes(self.width, "little") for x in biased[d]),
                                            np.uint8).reshape(len(part), self.width)
            else:
                own = np.ascontiguousarray(biased, np.uint64).view(np.uint8).reshape(self.dims, len(part), 8)
                wide[:] = own[:, :, :self.width]
            self.parts.append([int.from_bytes(wide[d].tobytes(), "little") for d in range(self.dims)])

    def scores(self, anchor):
        """Inner products of the list ``anchor`` with all candidates, in their order."""
        import numpy as np

        shifted = [a + self.shift for a in anchor]
        out = []
        for part in self.parts:
            total = 0
            for wide, a in zip(part, shifted):
                if a:
                    total += wide * a
            n = min(FIELDS, self.n - len(out) * FIELDS)
            out.append(np.frombuffer(total.to_bytes(n * self.width, "little"), np.uint8).reshape(n, self.width))
        fields = np.concatenate(out)
        away = self.bias * (sum(anchor) + self.shift * self.dims)  # what the candidates' bias adds to each field
        if self.width > 7:
            exact = [int.from_bytes(f.tobytes(), "little") - away - self.shift * s for f, s in zip(fields, self.sums)]
            return np.array([max(-TOP - 1, min(TOP, x)) for x in exact], np.int64)
        whole = np.zeros((self.n, 8), np.uint8)
        whole[:, :self.width] = fields
        return whole.view(np.int64)[:, 0] - away - self.shift * self.sums


def _matrix(column, dims: int):
    """Rows x ``dims`` of an Arrow list column, short rows filled with 0."""
    import numpy as np
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = column.flatten().to_numpy()
    return out


def _cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, work, schema: str) -> DataFrame:
    """``work(matrix, ids, labels, row numbers, anchors)`` for every pair of a group of rows and one of anchors.

    Groups go by a hash of the row number, so no id, label or vector makes one of them hot."""
    groups, sets = 1 + n_rows // GROUP, 1 + n_anchors // ANCHORS

    def dealt(df: DataFrame, own: int, other: int, first: str, second: str) -> DataFrame:
        own_columns = df.select(*[F.col(c).alias(c) for c in df.columns])  # both sides come from one table
        return own_columns.withColumn(first, F.pmod(F.xxhash64("_row"), F.lit(own))).withColumn(
            second, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long"))))

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], as_arrow(pa))
        right = right.sort_by("_row")
        left = left.sort_by([("_id", "ascending"), ("_row", "ascending")])  # nulls come last
        dims = max(int(np.diff(t.column("_q").combine_chunks().offsets.to_numpy()).max()) for t in (left, right))
        q, a = _matrix(left.column("_q"), dims), _matrix(right.column("_q"), dims)
        packed = Packed(q, int(a.max()) if a.size else 0, int(a.min()) if a.size else 0)
        ids = left.column("_id").combine_chunks()
        out = work(packed, left.column("_label").to_numpy(), left.column("_row").to_numpy(), a.tolist(), right)
        names = as_arrow(pa).names
        at = np.concatenate([o.pop("at") for o in out]) if out else np.zeros(0, np.int64)
        cols = {k: np.concatenate([o[k] for o in out]) for k in out[0]} if out else {}
        cols |= {"id": ids.take(pa.array(at)), "row": left.column("_row").combine_chunks().take(pa.array(at))}
        return pa.table({k: cols.get(k, []) for k in names}, as_arrow(pa))

    def as_arrow(pa):
        kinds = {"long": pa.int64(), "int": pa.int32()}
        return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    keys = ["_group", "_set"]
    return dealt(rows, groups, sets, "_group", "_set").groupBy(*keys).cogroup(
        dealt(anchors, sets, groups, "_set", "_group").groupBy(*keys)).applyInArrow(run, schema)


def _best(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each key, numbered from 1 as ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    ``anchor``: which rows are anchors. An anchor's positives are the ``positives`` rows of its label that
    score highest; a negative has another label and a score of ``low`` to ``high`` percent of the positive's."""
    own = F.col(label) if isinstance(label, str) else label
    vec = F.col(vector)
    sound = own.isNotNull() & vec.isNotNull() & ~F.exists(
        vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = written(vectors.where(sound).select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), own.cast("long").alias("_label"),
        F.transform(vec, lambda x: quantised(x, scale)).alias("_q"),
        (F.coalesce(anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("_anchor")), "vectors")
    anchors = rows.where("_anchor").select("_row", "_id", "_label", "_q")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("_anchor")).first()
    rows = rows.drop("_anchor")

    def same_label(packed, labels, numbers, q, right):
        import numpy as np

        out = []
        for vec, lab, row in zip(q, right.column("_label").to_pylist(), right.column("_row").to_pylist()):
            s = packed.scores(vec)
            at = np.flatnonzero((labels == lab) & (numbers != row))
            at = at[np.argsort(-s[at], kind="stable")[:positives]]
            out.append({"at": at, "anchor": np.full(len(at), row), "score": s[at]})
        return out

    first = _best(_cells(rows, anchors, n_rows, n_anchors, same_label, "anchor long, score long, id long, row long"),
                  ["anchor"], positives)
    first = written(first, "positives")
    held = first.groupBy(F.col("anchor").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("_p"))
    asked = anchors.join(held.select("_row", F.transform("_p", lambda p: p["score"]).alias("_p")), "_row")

    def between(packed, labels, numbers, q, right):
        import numpy as np

        out = []
        for vec, lab, row, bounds in zip(q, right.column("_label").to_pylist(), right.column("_row").to_pylist(),
                                         right.column("_p").to_pylist()):
            s = packed.scores(vec)
            other = np.flatnonzero(labels != lab)
            for k, p in enumerate(bounds):
                least, most = -(-low * p // 100), high * p // 100
                if least > most:
                    continue
                at = other[(s[other] >= least) & (s[other] <= most)]
                at = at[np.argsort(-s[at], kind="stable")[:negatives]]
                out.append({"at": at, "anchor": np.full(len(at), row), "positive": np.full(len(at), k + 1), "score": s[at]})
        return out

    found = _cells(rows, asked, n_rows, n_anchors, between, "anchor long, positive int, score long, id long, row long")
    found = written(_best(found, ["anchor", "positive"], negatives), "negatives")
    named = first.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score")).join(
        anchors.select(F.col("_row").alias("anchor"), F.col("_id").alias("anchor_id")), "anchor")
    result = written(found.join(named, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("positive").alias("positive_rank"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")), "mined")
    discard(rows, first, found)
    return result


ship_by_value(__name__)
