"""Files that say which folders make up a table: commit records and versioned manifests.

They are written beside and renamed, without replacing anything, so that a
reader finds a whole record or none, and of two writers of one version the second
fails. Everything goes through Hadoop's file system, so any store will do. A
record is driver-sized: it names folders, never rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names below ``folder``, sorted; none where it does not exist."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_record(spark: SparkSession, path: str, content: dict) -> None:
    """Write ``content`` as JSON to ``path``, whole or not at all; an error where it exists."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    _, final = _fs(spark, path)
    fs, beside = _fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = fs.create(beside)
    try:
        out.write(json.dumps(content).encode())
    finally:
        out.close()
    options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(beside), fs.makeQualified(final), options)
    except Exception as e:
        fs.delete(beside, False)
        raise FileExistsError(f"{path}: written by another job meanwhile") from e


def read_record(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    data = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8"))
    finally:
        data.close()


def latest(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """The newest manifest of ``root`` and its version; (0, None) without one."""
    found = [n for n in names(spark, f"{root}/_manifest") if n.startswith("v")]
    return (int(found[-1][1:-5]), read_record(spark, f"{root}/_manifest/{found[-1]}")) if found else (0, None)


def swap(spark: SparkSession, root: str, version: int, state: dict) -> None:
    """Make ``state`` the manifest that follows ``version``."""
    write_record(spark, f"{root}/_manifest/v{version + 1:012d}.json", state)
