"""The registered queries against their DuckDB SQL on the smallest tables,
and the driver's entry smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as ent
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "supplier", "part", "orders", "lineitem"]
CHECKED = ["g2_train_grid", "g4_w1_w4_clean_oil", "a1_holiday_store_features", "t18_feature_dataset",
           "t4_baseline_backtest", "t5_rolling_validation", "t6_submission", "a4_cleaning_counters",
           "w10_positional_split", "a19_box_by_store_type", "a3_quality_report", "t13_order_search", "t14_straight_line",
           "j12_future_frame_with_oil", "t17_train_and_compare_line"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(table):
    cols = sorted(table.column_names)
    rows = [tuple(r[c] for c in cols) for r in table.select(cols).to_pylist()]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="benchmark tables absent")
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    got = ent.queries()[name](spark, SF_SMALL).toArrow()
    want = duck.execute(ent.oracle_sql()[name]).to_arrow_table()
    assert _rows(got) == _rows(want)


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="benchmark tables absent")
def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"store_nbr", "family", "rmsle", "rmse", "mae"}
