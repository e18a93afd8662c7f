"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracle import TABLES, digest, type_mismatches  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert not type_mismatches(sdf, cur.description)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, dcols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 876
    assert df.columns == ["book_name", "book_id", "chapter", "verse", "en_text", "fr_text",
                          "de_text", "es_text"]
