import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import brute
from parcorpus.llm import chat, hilbert, linededup
from parcorpus.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def keyed(spark, rows):
    """The order of (id, text): by id, nulls first, then by the hash that the operator uses."""
    df = spark.createDataFrame(rows, "d long, t string").select("d", "t", F.xxhash64("t").alias("h"))
    h = {(r["d"], r["t"]): r["h"] for r in df.collect()}
    return lambda d, t: (d is not None, d or 0, h[d, t])


def check_lines(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, runs int")
    want = brute.dedup_lines(rows, keyed(spark, rows), **kw)
    got = linededup.dedup_lines(df, **kw).collect()
    assert len(got) == len(rows)
    expect = Counter((d, *want[d, t]) for d, t in rows)
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_deleted"]) for r in got) == expect


def test_line_runs_match_brute_force(spark):
    rng = random.Random(11)
    rows = [(d, "\n".join(rng.choice("abcdef") for _ in range(rng.randint(0, 14)))) for d in range(40)]
    rows += [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "q\nr\ns"), (99, "q\nr\ns\nt"), (100, None), (101, ""),
             (102, "k\n\n \nl\nm"), (103, "z\nk\nl\n\nm\nz"), (104, "w " * 60 + "\nx1"), (105, "x2\n" + "w " * 60),
             (106, "s\n" * 200), (107, "\n".join(f"u{i}" for i in range(300))), (108, "\n".join(f"u{i}" for i in range(10, 300)))]
    check_lines(spark, rows)
    check_lines(spark, rows, min_lines=3)


def test_line_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute.dedup_lines(rows, keyed(spark, rows))
    for r in QUERIES["op7_line_dedup"](spark, SF).collect():
        assert (r["text"], r["n_lines"], r["n_deleted"]) == want[next(k for k in want if k[0] == r["doc_id"])]


def test_runs_are_maximal_and_name_their_source(spark):
    rows = [(1, "a\nb\nc\nd\ne\nf\ng"), (2, "x\nb\nc\nd\ne\nf\ny"), (3, "p\nq\nr")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in linededup.dedup_lines(df).collect()}
    assert got == {1: [], 2: [(1, 6, 1)], 3: []}
    assert linededup.dedup_lines(df.limit(0)).count() == 0
    assert linededup.dedup_lines(df.where("doc_id = 3")).first()["text"] == "p\nq\nr"


def rotated(turns):
    """{(conv, perspective): (text, masked text)}."""
    convs = defaultdict(list)
    for t in turns:
        convs[t[0]].append(t)
    out = {}
    none = lambda x: (x is not None, x if x is not None else "")
    for c, ts in convs.items():
        ts.sort(key=lambda t: ((t[1] is not None, t[1] or 0), none(t[2]), (t[3] or "").replace("<|", "< |")))
        for who in {t[2] for t in ts} - {None, "system"}:
            text, mask = "", []
            for _, _, role, body in ts:
                body = (body or "").replace("<|", "< |") + "<|end|>\n"
                head = ("<|system|>\n" if role == "system" else "<|assistant|>\n" if role == who else f"<|user|>\n{role or 'unknown'}: ")
                text += head
                if role == who:
                    mask.append(body)
                text += body
            out[c, who] = (text, mask)
    return out


def test_rotation(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo <|assistant|> x"), (1, 2, "cy", None), (1, 3, None, "?"),
             (1, 3, None, "?"), (None, 1, "ann", "lost"), (2, 0, "system", "alone"), (3, None, "ann", "é" * 1000)]
    turns += [(4, i, "ann" if i % 2 else "bob", f"turn {i}") for i in range(300)]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, segment int")
    got = defaultdict(list)
    for r in chat.rotate(df).collect():
        got[r["conv_id"], r["perspective"]].append(r)
    want = rotated(turns)
    assert set(got) == set(want)
    for k, rows in got.items():
        rows.sort(key=lambda r: r["segment"])
        assert "".join(r["text"] for r in rows) == want[k][0]
        assert [r["text"][s["start"]:s["end"]] for r in rows for s in r["mask_spans"]] == want[k][1]
        at = 0
        for r in rows:
            assert r["start_char"] == at and r["n_turns"] <= chat.SEGMENT_TURNS
            at += len(r["text"])
    assert len(got[4, "ann"]) == 3
    assert chat.rotate(df.limit(0)).count() == 0


def test_curve_is_one_path_through_all_cells(spark):
    for n, bits in ((2, 3), (3, 3)):
        cells = spark.range(1 << n * bits).select(*[F.expr(f"(id >> {k * bits}) & {(1 << bits) - 1}").cast("int").alias(f"c{k}") for k in range(n)])
        rows = cells.select("*", hilbert.hilbert_index([F.col(f"c{k}") for k in range(n)], bits).alias("h")).collect()
        rows.sort(key=lambda r: r["h"])
        assert [r["h"] for r in rows] == list(range(len(rows)))
        assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(rows, rows[1:]))


def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = QUERIES["op9_hilbert_sharding"](spark, SF).collect()
    want = Counter((d["doc_id"], len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode())) for d in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_shard_edges_and_pruning(spark):
    rows = [(None, None, 5), (1, "x", None), (1, "x", None), (2, "", 7)] + [(i, f"s{i % 3}", i) for i in range(3, 60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = hilbert.hilbert_shards(df, ["source", "size"], ["doc_id"], 7)
    got = out.collect()
    assert len(got) == len(rows) and max(Counter(r["shard"] for r in got).values()) == 9
    index = hilbert.manifest(out, ["source", "size"])
    hit = {r["shard"] for r in hilbert.prune(index, source="s1", size=10).collect()}
    assert {r["shard"] for r in got if r["source"] == "s1" and r["size"] == 10} <= hit and len(hit) < 7
    assert hilbert.hilbert_shards(df.limit(0), ["source", "size"], ["doc_id"], 7).count() == 0


def test_strings_with_a_common_beginning_fill_many_cells(spark):
    rows = [(k, f"https://h{k % 7}.org") for k in range(200)] + [(900, None), (901, "")]
    cells = hilbert.with_cells(spark.createDataFrame(rows, "id long, source string"), ["source"]).collect()
    by = {r["source"]: r["_cell_0"] for r in cells}
    assert len(cells) == 202 and len(set(by.values())) == 7 and by[None] == 0 and by[""] == 0  # "" is with the first host
    assert [by[f"https://h{k}.org"] for k in range(7)] == sorted(by[f"https://h{k}.org"] for k in range(7))


def place(axes, bits):
    """Index on the Hilbert curve of one cell: undo excess turns, Gray decode, interleave."""
    x, n = list(axes), len(axes)
    q = 1 << (bits - 1)
    while q > 1:
        for k in range(n):
            if x[k] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[k]) & (q - 1)
                x[0], x[k] = x[0] ^ t, x[k] ^ t
        q >>= 1
    for k in range(1, n):
        x[k] ^= x[k - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        t ^= q - 1 if x[-1] & q else 0
        q >>= 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_shard_query_matches_brute_force(spark):
    docs = [(d["doc_id"], d["lang"], d["source"], len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode()))
            for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n = 1 << hilbert.BITS
    cells = []
    for k in (1, 2, 3):
        values = sorted(d[k] for d in docs if d[k] is not None)
        if k == 3:  # a cell ends at the value of its rank
            cuts = sorted({values[-(-len(values) * j // n) - 1] for j in range(1, n)})
            cells.append([sum(d[k] > c for c in cuts) for d in docs])
        else:
            first = {}
            for at, v in enumerate(values):
                first.setdefault(v, at * n // len(values))
            cuts = [min(v for v in first if first[v] == c) for c in sorted(set(first.values())) if c]
            cells.append([0 if d[k] is None else sum(d[k] >= c for c in cuts) for d in docs])
    order = sorted((place(c, hilbert.BITS), d[0], d[4], d[3]) for c, d in zip(zip(*cells), docs))
    want, slots = [], Counter()
    for at, (h, d, crc, size) in enumerate(order):
        shard = at * 24 // len(order)
        want.append((d, size, crc, "rows", shard, slots[shard], None, h))
        slots[shard] += 1
    assert sorted(map(tuple, QUERIES["op9_hilbert_sharding"](spark, SF).collect())) == sorted(want)
