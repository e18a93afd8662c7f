"""Disk that grows less than the texts: what the findings of round 4 name."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from parcorpus.operators import dedup
from parcorpus.plans import queries
from parcorpus.plans import views as V
from parcorpus.streaming import ingest
from tests.conftest import SF_SMALL, rows


@pytest.fixture
def written(monkeypatch):
    """(path, plan) of each table of JSON that is written."""
    found, write = [], DataFrameWriter.json

    def note(self, path, *args, **kw):
        found.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "json", note)
    return found


def test_rows_of_a_batch_are_dealt_out_once(spark, tmp_path, written):
    """the stored keys come to the rows, where the first of each key has been found."""
    corpus = str(tmp_path / "corpus")
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for i, pairs in enumerate(([("a", "A"), ("b", "B")], [("b", "B"), ("c", "C"), ("c", "C"), ("bc", ""), ("b", "c")])):
            ingest.process_batch(spark.createDataFrame([(*p, None, k) for k, p in enumerate(pairs)], ingest.PARTIAL_SCHEMA), i, corpus)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    plan = written[1][1]
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted(rows(ingest.read_corpus(spark, corpus), "sl", "tl", "batch_id")) == [
        ("a", "A", 0), ("b", "B", 0), ("b", "c", 1), ("bc", "", 1), ("c", "C", 1)]


def test_ingested_texts_are_compressed_and_not_dealt_out_beforehand(spark, written, monkeypatch):
    """part files come from the scan as it is; they and the corpus take up less than the texts in them. The corpus is whole."""
    limits, start = [], ingest.start_ingest

    def note(*args, **kw):
        limits.append(kw["max_files_per_trigger"])
        return start(*args, **kw)

    monkeypatch.setattr(ingest, "start_ingest", note)
    got = queries.ingest_partials(spark, SF_SMALL)
    tr = V.translations(spark, SF_SMALL)
    want = dedup.clean_corpus(tr).select("sl", "tl")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert "Exchange" not in written[0][1]
    assert len(written) == 1 + queries.MICRO_BATCHES

    def size(path):
        path = path.removeprefix("file:")
        return [os.path.getsize(f"{path}/{n}") for n in os.listdir(path) if n.startswith("part-")]

    text = tr.agg(*[F.sum(F.octet_length(c)) for c in ("sl", "tl", "ol")]).first()
    parts, stored = size(written[0][0]), [n for path, _ in written[1:] for n in size(path)]
    assert -(-len(parts) // limits[0]) == queries.MICRO_BATCHES
    assert sum(parts) < sum(text) / 2 and sum(stored) < sum(text) / 2


def test_shuffles_of_a_batch_end_with_its_writes(spark, tmp_path, monkeypatch):
    """the stream's own session frees them; the caller's is left as it was."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "corpus", "ck"))
    seen, process = [], ingest.process_batch

    def note(df, *args):
        seen.append(df.sparkSession.conf.get(ingest.CLEANUP))
        process(df, *args)

    monkeypatch.setattr(ingest, "process_batch", note)
    was = spark.conf.get(ingest.CLEANUP)
    spark.createDataFrame([("a", "A", None, 1), ("a", "A", None, 2), ("b", "b", None, 3)], ingest.PARTIAL_SCHEMA).coalesce(1).write.json(src)
    ingest.start_ingest(spark, src, out, ck, max_files_per_trigger=1).awaitTermination()
    assert set(seen) == {"true"} and spark.conf.get(ingest.CLEANUP) == was
    assert rows(ingest.read_corpus(spark, out), "sl", "tl", "pos") == [("a", "A", 1)]


def test_an_index_of_other_keys_is_refused(spark, tmp_path):
    """the index holds digests now; one of the former hashes must not pass for an empty one."""
    corpus = str(tmp_path / "corpus")
    batch = spark.createDataFrame([("a", "A", None, 1)], ingest.PARTIAL_SCHEMA)
    bucket = ingest._with_key(batch).first()["bucket"]
    ingest.process_batch(spark.createDataFrame([("x", "X", None, 1)], ingest.PARTIAL_SCHEMA), 0, corpus)
    spark.range(1).select(F.col("id").alias("k1"), F.col("id").alias("k2")).write.parquet(f"{corpus}/_keys/bucket={bucket}/epoch=batch-0", mode="overwrite")
    with pytest.raises(Exception, match="holds no digests"):
        ingest.process_batch(batch, 1, corpus)
