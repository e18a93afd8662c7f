import math
import random

from parcorpus.llm import hardneg
from parcorpus.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<double>, label int, score string, rank long, _row int"


def brute(rows, positives=5, negatives=10):
    """Rows (position, id, label, vector) by the definition, with plain whole numbers."""
    own = [(n, i, lab, [math.floor(256 * x) for x in v]) for n, (i, v, lab) in enumerate(rows)
           if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, lab, q in own:
        if i is None or i % 10:
            continue
        s = sorted((-sum(a * b for a, b in zip(q, p)), j is None, j or 0, m, other) for m, j, other, p in own if m != n)
        for rank, (p, null, pid, m, _) in enumerate([x for x in s if x[4] == lab][:positives], 1):
            fit = [x for x in s if x[4] != lab and 30 * -p <= 100 * -x[0] <= 90 * -p]
            for k, x in enumerate(fit[:negatives], 1):
                out.append((i, None if null else pid, rank, k, None if x[1] else x[2], -p, -x[0]))
    return out


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], KIND).coalesce(1)
    return sorted(map(repr, (tuple(r) for r in hardneg.mine(df, F.col("vec_id") % 10 == 0).collect())))


def test_mining_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "GROUP", 40)  # several groups of rows and of anchors, several wide integers each
    monkeypatch.setattr(hardneg, "ANCHORS", 5)
    monkeypatch.setattr(hardneg, "FIELDS", 16)
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0.2, 0.4) for _ in range(6)], rng.randint(0, 2)) for k in range(150)]
    rows += [(500 + k, [0.5, 0.25, 0.0, 0.0, 0.5, 0.5], k % 3) for k in range(40)]  # ties
    rows += [(10, rows[10][1], rows[10][2])] * 2 + [(None, rows[20][1], 1), (None, [0.5] * 6, 0)]  # repeated and null ids
    rows += [(600, None, 1), (610, [0.1, None], 1), (620, [float("nan")] * 6, 1), (630, [float("inf")] * 6, 1),
             (640, [0.5] * 6, None), (650, [], 1), (660, [0.5, 0.5], 2), (-10, [-3.0] * 6, 1)]
    assert mined(spark, rows) == sorted(map(repr, brute(rows)))


def test_wide_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(k, [rng.uniform(-1, 4) * 2 ** rng.choice([0, 20]) for _ in range(4)], k % 2) for k in range(60)]
    want = brute(rows)
    assert max(w[5] for w in want) > 1 << 50
    assert mined(spark, rows) == sorted(map(repr, want))


def test_packed_products(spark):
    import numpy as np

    rng = random.Random(7)
    for size in (1, 300, 1 << 12, 1 << 40, 1 << 61):
        q = np.array([[rng.randint(-size, size) for _ in range(3)] for _ in range(50)], np.int64)
        anchor = [rng.randint(-size, size) for _ in range(3)]
        got = hardneg.Packed(q, max(anchor), min(anchor)).scores(anchor).tolist()
        exact = [sum(a * b for a, b in zip(anchor, r)) for r in q.tolist()]
        assert got == [max(-hardneg.TOP - 1, min(hardneg.TOP, x)) for x in exact]


def test_edges_and_query(spark):
    empty = spark.createDataFrame([], KIND)
    assert hardneg.mine(empty, F.col("vec_id") % 10 == 0).count() == 0
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []  # no anchor
    assert mined(spark, [(10, [], 1), (20, [], 1), (30, [], 2)]) == sorted(map(repr, brute([(10, [], 1), (20, [], 1), (30, [], 2)])))
    got = QUERIES["op11_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.groupBy("anchor_id").count().count() > 0
