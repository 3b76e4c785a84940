"""Every query with an oracle, on sf0.001, against DuckDB (same compare as
scripts/oracle_check.py); rows-only queries must at least run."""

import duckdb
import pytest

import __spark_entry__ as E
from basketflow.plans import catalog
from basketflow.sources.tables import TABLES
from scripts.oracle_check import compare

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    a = df.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(a) > 0
        return
    b = con.execute(sql).df()
    ok, msg = compare(a, b)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "item_id", "score"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_known_rows_only():
    # the optional training-data package states its own list in its own tests
    rows_only = set(catalog.queries()) - set(catalog.oracle_sql())
    assert rows_only == {"lcs_pairs", "tfidf_hashed", "lr_model", "lr_loss", "lr_holdout", "lr_score_test_users", "lr_auc",
                         "segment_lattice"}
