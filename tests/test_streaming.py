"""Ingesting partial files is idempotent and equals the batch rule."""

import os
import tempfile

import pytest

from parcorpus.streaming import ingest
from tests.conftest import rows


def test_ingest_twice_leaves_corpus_unchanged(spark):
    base = tempfile.mkdtemp(prefix="parcorpus-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "corpus", "ck"))
    data = [("a", "A", "o", 1), ("a", "A", "o", 2), ("b", "b", "o", 3), ("c", "[ERROR]", "o", 4),
            ("d", "D", "o", 5), ("a", "A", "o", 6), ("e", "E", "o", 7)]
    df = spark.createDataFrame(data, ingest.PARTIAL_SCHEMA)
    df.repartition(3).write.json(src)
    ingest.start_ingest(spark, src, out, ck, max_files_per_trigger=1).awaitTermination()
    first = sorted(rows(ingest.read_corpus(spark, out), "sl", "tl"))
    assert first == [("a", "A"), ("d", "D"), ("e", "E")]
    # second run over the same files (fresh checkpoint: every file is read again)
    ingest.start_ingest(spark, src, out, os.path.join(base, "ck2"),
                        max_files_per_trigger=1).awaitTermination()
    assert sorted(rows(ingest.read_corpus(spark, out), "sl", "tl")) == first


def test_ingest_with_state_store(spark):
    base = tempfile.mkdtemp(prefix="parcorpus-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "corpus", "ck"))
    data = [("a", "A", "o", 1), ("a", "A", "o", 2), ("b", "b", "o", 3), ("c", "[ERROR]", "o", 4),
            ("d", "D", "o", 5), ("a", "A", "o", 6), ("e", "E", "o", 7)]
    spark.createDataFrame(data, ingest.PARTIAL_SCHEMA).repartition(3).write.json(src)
    ingest.start_ingest(spark, src, out, ck, max_files_per_trigger=1, dedup="state").awaitTermination()
    got = sorted(rows(ingest.read_corpus(spark, out, dedup="state"), "sl", "tl"))
    assert got == [("a", "A"), ("d", "D"), ("e", "E")]
    # restart from the same checkpoint: nothing new is written
    ingest.start_ingest(spark, src, out, ck, max_files_per_trigger=1, dedup="state").awaitTermination()
    assert sorted(rows(ingest.read_corpus(spark, out, dedup="state"), "sl", "tl")) == got


def test_missing_side_is_stored_once(spark):
    base = tempfile.mkdtemp(prefix="parcorpus-stream-")
    out = os.path.join(base, "corpus")
    batch = spark.createDataFrame([("a", None, "o", 1), ("a", None, "o", 2), ("b", "B", "o", 3)], ingest.PARTIAL_SCHEMA)
    for k in range(3):
        ingest.process_batch(batch, k, out)
    assert sorted(rows(ingest.read_corpus(spark, out), "sl", "tl"), key=str) == [("a", None), ("b", "B")]


def _batch(spark, *pairs):
    return spark.createDataFrame([(s, t, "o", k) for k, (s, t) in enumerate(pairs)], ingest.PARTIAL_SCHEMA)


def test_a_batch_reads_its_own_buckets_only(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="parcorpus-stream-"), "corpus")
    ingest.process_batch(_batch(spark, *[(f"s{k}", f"t{k}") for k in range(300)]), 0, out)
    batch = _batch(spark, ("s7", "t7"), ("new", "NEW"))
    buckets = {r["bucket"] for r in ingest._with_key(batch).collect()}
    there = {n for n in os.listdir(os.path.join(out, "_keys")) if n.startswith("bucket=")}
    assert len(there) > 50
    read = {f.split("/_keys/")[1].split("/")[0] for f in ingest.stored_keys(spark, out, sorted(buckets)).inputFiles()}
    assert read and read <= {f"bucket={b}" for b in buckets}
    # files of other buckets are not opened: broken ones do no harm
    for n in there - {f"bucket={b}" for b in buckets}:
        for d, _, files in os.walk(os.path.join(out, "_keys", n)):
            for f in files:
                if f.endswith(".parquet"):
                    open(os.path.join(d, f), "w").close()
    ingest.process_batch(batch, 1, out)
    assert rows(ingest.read_corpus(spark, out).where("batch_id = 1"), "sl", "tl") == [("new", "NEW")]


def test_replays_are_exact(spark, monkeypatch):
    out = os.path.join(tempfile.mkdtemp(prefix="parcorpus-stream-"), "corpus")
    one, two = _batch(spark, ("a", "A"), ("b", "B"), ("a", "A")), _batch(spark, ("b", "B"), ("c", "C"))
    ingest.process_batch(one, 0, out)
    with monkeypatch.context() as m:  # killed before its commit: neither rows nor keys count
        m.setattr(ingest.manifest, "write_record", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            ingest.process_batch(two, 1, out)
    assert sorted(rows(ingest.read_corpus(spark, out), "sl")) == [("a",), ("b",)]
    ingest.process_batch(_batch(spark, ("c", "C")), 0, out, stream="other")  # its keys don't hide the pair from others
    for _ in range(3):
        ingest.process_batch(two, 1, out)
        ingest.process_batch(one, 0, out)
        assert sorted(rows(ingest.read_corpus(spark, out), "sl")) == [("a",), ("b",), ("c",)]
    ingest.compact_keys(spark, out)
    ingest.process_batch(_batch(spark, ("a", "A"), ("c", "C"), ("d", "D")), 2, out)
    assert sorted(rows(ingest.read_corpus(spark, out), "sl")) == [("a",), ("b",), ("c",), ("d",)]


def test_state_with_a_bound_on_age(spark):
    base = tempfile.mkdtemp(prefix="parcorpus-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "corpus", "ck"))
    _batch(spark, ("a", "A"), ("a", "A"), ("b", "b"), ("e", "E")).repartition(2).write.json(src)
    ingest.start_ingest(spark, src, out, ck, max_files_per_trigger=1, dedup="state", within="1 hour").awaitTermination()
    assert sorted(rows(ingest.read_corpus(spark, out, dedup="state"), "sl")) == [("a",), ("e",)]
