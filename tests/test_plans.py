"""Plan checks: Python workers only where a user function runs, no
single-partition exchange on data-sized tables, pruned scans."""

import pytest

from parcorpus.plans.queries import REGISTRY
from tests.conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
PY_ALLOWED = {"translate_batches", "translate_pairs", "map_batched"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _bad_single_partition(plan: str) -> list[str]:
    """Single-partition exchanges whose input is not already reduced to one
    partial row per task (a global partial aggregate)."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            # HashAggregate prints "keys=[]", SortAggregate "key=[]"
            if "HashAggregate(keys=[]" not in child and "SortAggregate(key=[]" not in child:
                bad.append(line.strip())
    return bad


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_shape(spark, name):
    if name == "ingest_partials":
        pytest.skip("streaming query runs on call")
    plan = _plan(REGISTRY[name](spark, SF_SMALL))
    if name not in PY_ALLOWED:
        assert not any(n in plan for n in PY_NODES), plan
    assert not _bad_single_partition(plan), plan


def test_scan_is_pruned(spark):
    plan = _plan(REGISTRY["merge_versions"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in plan
    assert "n_chars" not in plan


def test_union_languages_scans_once(spark):
    plan = _plan(REGISTRY["valid_pairs"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1, plan


@pytest.mark.parametrize("name", ["salvage", "alignment_report", "first_suspicious_verse", "range_label", "chapter_consistency"])
def test_alignment_runs_no_job_while_it_is_planned(spark, name, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **b: pytest.fail("wrote a table"))
    plan = _plan(REGISTRY[name](spark, SF_SMALL))
    assert "FileScan parquet" in plan
