"""Driver contract: entry(), queries() and oracle_sql() on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.registry import ORACLE, QUERIES
from strata.sources.tables import DRIVER_TABLES, table_path

from small_tables import SF_SMALL


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "ano_mes" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", ["dedup_best", "duplicate_summary", "fact_monthly",
                                 "yearly_answer", "climatology", "quality_checks"])
def test_query_matches_oracle_small(spark, key):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    sdf = queries()[key](spark, SF_SMALL)
    got = sorted(tuple(str(v) for _, v in sorted(r.asDict().items())) for r in sdf.collect())
    res = con.execute(oracle_sql()[key])
    cols = [d[0] for d in res.description]
    want = sorted(tuple(str(v) for _, v in sorted(zip(cols, row))) for row in res.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert got == want
