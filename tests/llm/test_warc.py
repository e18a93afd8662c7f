import base64
import glob
import gzip
import hashlib
import random
import zlib

from parcorpus.llm import warc
from parcorpus.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string, path string, block long"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def archived(spark, rows, folder, split=None, payload=True):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND)
    warc.write_archive(df, folder, "page_id", "url", "html")
    return read(spark, folder, split, payload)


def read(spark, folder, split=None, payload=True):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        return [r.asDict() for r in warc.read_archive(spark, folder, payload).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
        spark.conf.unset("spark.sql.files.minPartitionNum")


def pages(rng):
    rows = [(k, f"http://h{k}.org/a b", " ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(rng.choice([0, 3, 40, 900])))) for k in range(60)]
    rows += [(100 + k, "http://x.org/", "the same page") for k in range(40)] + [(99, None, "the same page")]
    rows += [(7, "http://x.org/", "twice")] * 2 + [(None, "u", "twice"), (None, "u", "no id"), (200, "u", None), (201, "u", ""),
                                                  (202, "u", "\u00e9\r\n\r\n\x1f\x8b\x08 WARC/1.1\r\n"), (203, "u", "long " * 200_000)]
    return rows


def check(rows, found):
    """Every row is read back: one response per payload, under the smallest id, and the others as its revisits."""
    got = [r for r in found if r["type"] != "warcinfo"]
    assert {r["status"] for r in found} == {"ok"} and len(got) == len(rows) and len({r["record_id"] for r in got}) == len(rows)
    least = {}
    for i, _, h in rows:
        data = (h or "").encode()
        least[data] = min([x for x in (least.get(data), i) if x is not None], default=None)
    text = {b32(d): d for d in least}
    assert sorted(map(repr, ((i, b32((h or "").encode())) for i, _, h in rows))) == sorted(
        repr((None if (own := warc.own_id(r["record_id"])) is None else int(own), r["payload_digest"])) for r in got)
    for r in got:
        data = text[r["payload_digest"]]
        assert r["payload_bytes"] == len(data) and r["declared_digest"] == r["payload_digest"]
        if r["type"] == "response":
            assert r["payload"] == data and r["refers_to"] is None
            assert warc.own_id(r["record_id"]) == (None if least[data] is None else str(least[data]))
        else:
            assert r["payload"] is None and warc.own_id(r["refers_to"]) == (None if least[data] is None else str(least[data]))
    assert sum(r["type"] == "response" for r in got) == len(least)
    assert {r["refers_to"] for r in got if r["type"] == "revisit"} <= {r["record_id"] for r in got if r["type"] == "response"}


def test_round_trip_by_ranges_of_any_size(spark, tmp_path):
    rows = pages(random.Random(1))
    check(rows, archived(spark, rows, str(tmp_path / "a")))
    for split in ("97", "1001", "5000", "40000"):  # ranges that cut headers, members and magics
        check(rows, read(spark, str(tmp_path / "a"), split))


def test_files_are_gzip_members_of_one_record_each(spark, tmp_path):
    rows = pages(random.Random(2))
    archived(spark, rows, str(tmp_path / "a"))
    found = 0
    for f in glob.glob(str(tmp_path / "a" / "part-*")):
        data, whole = open(f, "rb").read(), b""
        assert gzip.decompress(data)
        while data:
            z = zlib.decompressobj(31)
            one = z.decompress(data)
            assert z.eof and (not one or one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n"))
            found += b"WARC-Type: response" in one[:30] or b"WARC-Type: revisit" in one[:30]
            data, whole = z.unused_data, whole + one
    assert found == len(rows)


def test_magic_inside_a_record_and_damage(spark, tmp_path):
    """Records whose compressed bytes hold the magic, at every place against the ranges; cut and altered ones."""
    rng = random.Random(3)

    def stored(block, kind="resource"):  # not compressed: the data stands as it is
        data = warc.record(kind, {"WARC-Record-ID": f"<urn:record:{rng.randint(0, 10 ** 9)}:0>", "Content-Type": "application/http",
                                  "WARC-Payload-Digest": "sha1:" + b32(block.partition(b"\r\n\r\n")[2])}, block)
        z = zlib.compressobj(0, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()

    payloads = [b"a" * rng.randint(0, 90) + warc.MAGIC * rng.choice([1, 2]) + bytes(rng.randrange(256) for _ in range(50)) for _ in range(40)]
    folder = tmp_path / "b"
    folder.mkdir()
    (folder / "one.warc").write_bytes(b"".join(stored(b"HTTP/1.1 200 OK\r\n\r\n" + p) for p in payloads))
    for split in ("64", "150", "333", "1000", "100000"):
        got = read(spark, str(folder), split)
        assert {r["status"] for r in got} == {"ok"}
        assert sorted(r["payload"] for r in got) == sorted(payloads)
    good = stored(b"HTTP/1.1 200 OK\r\n\r\ngood")
    wrong = warc.member(warc.record("response", {"Content-Type": "application/http", "WARC-Payload-Digest": "sha1:" + "A" * 32},
                                    b"HTTP/1.1 200 OK\r\n\r\naltered"))
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "two.warc").write_bytes(b"junk" + good + good[:-30] + good + gzip.compress(b"no record") + wrong + good + good[:200])
    for split in ("100", "100000"):
        assert sorted(r["status"] for r in read(spark, str(folder), split)) == ["corrupt", "ok", "ok", "ok", "truncated", "truncated"]


def test_sink_rows_keep_members_whole():
    small, large = warc.member(b"x"), warc.member(b"\0" * (1 << 24))
    for members in ([small], [small, large], [large]):
        row = warc.sink_row(members) + b"\0"
        assert gzip.decompress(row) == b"".join(gzip.decompress(m) for m in members)


def test_empty_table_and_query(spark, tmp_path):
    assert archived(spark, [], str(tmp_path / "e")) == []
    rows = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op12_warc"](spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = got.collect()
    assert sorted(r["page_id"] for r in got) == sorted(rows)
    for r in got:
        data = (rows[r["page_id"]]["html"] or "").encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), b32(data))
