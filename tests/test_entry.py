"""Driver contract and an oracle comparison on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_runs_and_keys_match(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "ventas_perdidas_estimadas" in df.columns
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())  # every query of the engine has its oracle


@pytest.mark.parametrize("name", ["stockout_lost_sales", "asof_cost_margin", "neg_margin_summary", "mom_channel",
                                  "product_identity_map", "turnover_top10"])
def test_matches_duckdb_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ["region", "nation", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    assert sorted(ocols) == sorted(sdf.columns)
    order = sorted(ocols)
    def norm(v):
        if v is None:
            return (0, "")
        return (1, float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
    srows = sorted(tuple(norm(r[c]) for c in order) for r in sdf.collect())
    orows = sorted(tuple(norm(r[ocols.index(c)]) for c in order) for r in cur.fetchall())
    assert len(srows) == len(orows)
    assert srows == orows
