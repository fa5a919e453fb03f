"""The driver contract: flagship query, matching names, and a few queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 150
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["rd_filter", "bm_pos_filter", "um_window_counts", "sp_mid_filter", "ps_psi"])
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("lineitem", "supplier", "customer", "orders"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry_module.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = df.select(*[f"`{c}`" for c in cols]).collect()
    sql = ", ".join(f'"{c}"' for c in cols)
    theirs = db.execute(f"SELECT {sql} FROM ({entry_module.oracle_sql()[name]})").fetchall()
    as_rows = lambda rows: sorted(repr(tuple(round(v, 5) if isinstance(v, float) else v for v in r)) for r in rows)
    assert as_rows(mine) == as_rows(theirs)
