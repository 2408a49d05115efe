"""Every registered query against its DuckDB oracle on the smallest fixture, plus the entry smoke test."""

import duckdb
import pytest

import __spark_entry__ as E
from maskcorpus.plans.fixtures import BASE_TABLES
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _canon(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return "NULL" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared():
    # checked against the tokenizers library in test_bpe
    rows_only = {"bpe_vocab_660", "bpe_vocab_2000", "encode_whole_texts", "encode_datasets_2000"}
    own = {q for q in QUERIES if q != "pipeline" and not q.startswith("op")}
    assert own - set(ORACLE) == rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = duck.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    srows = sorted(tuple(_canon(r[c]) for c in order) for r in sdf.collect())
    drows = sorted(tuple(_canon(x[dcols.index(c)]) for c in order) for x in rel.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["id", "func_id", "func_no"]
