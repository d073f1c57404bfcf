"""Physical-plan properties of the headline jobs, checked with size-based
broadcasts off (as at scale, where the panel-sized sides exceed any
threshold): shuffle counts, pushdown, no Cartesian products, no Python."""

import re

import pytest

from shelfcast.operators import forecast
from shelfcast.plans.pipeline import TEST_START, VAL_START, pipeline_for
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)


@pytest.fixture(scope="module")
def feats(spark):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield pipeline_for(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_backtest_is_one_scan_without_shuffle(spark, feats):
    """The feature table is bucketed by series."""
    plan = _plan(forecast.baseline_backtest(feats.features, VAL_START, TEST_START))
    assert _shuffles(plan) == []
    assert plan.count("FileScan parquet") == 1
    assert "EqualTo(dataset_split,train)" in plan
    assert "ReadSchema: struct<date:date,dataset_split:string,store_nbr:int,family:string,sales:double>" in plan


def test_rolling_validation_does_not_shuffle(spark, feats):
    assert _shuffles(_plan(forecast.rolling_validation(feats.features))) == []


def test_an_unbucketed_panel_shuffles_once(spark, feats):
    plain = feats.features.select("*").repartition(3)
    for job in (forecast.baseline_backtest(plain, VAL_START, TEST_START), forecast.rolling_validation(plain)):
        shuffles = [s for s in _shuffles(_plan(job)) if s.startswith("hash")]
        assert len(shuffles) == 1 and shuffles[0].startswith("hashpartitioning(store_nbr")


def test_headline_jobs_stay_in_the_jvm(spark, feats):
    jobs = [forecast.baseline_backtest(feats.features, VAL_START, TEST_START),
            forecast.rolling_validation(feats.features),
            forecast.submission(feats.features, feats.cleaned.test)]
    for df in jobs:
        plan = _plan(df)
        assert "CartesianProduct" not in plan
        assert "Python" not in plan and "ArrowEval" not in plan


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_total_order_has_no_single_partition(spark):
    from shelfcast.operators import series

    df = spark.range(500).selectExpr("cast(id % 7 as int) store_nbr", "'A' family", "date_add(date'2001-01-01', cast(id / 7 as int)) date")
    out = series.positional_split(df, ["date"])
    plan = _executed(out)
    assert "SinglePartition" not in plan and "Window" not in plan
    rows = sorted((r.store_nbr, r.date, r.row_index, r.split) for r in out.collect())
    assert [r[2] for r in rows] == list(range(500)) and [r[3] for r in rows] == ["train"] * 400 + ["val"] * 100


def test_series_operators_read_the_bucketed_table_without_exchange(spark):
    from shelfcast.operators import series
    from shelfcast.session import stage_bucketed

    df = spark.range(2000).selectExpr("cast(id % 7 as int) store_nbr", "string(id % 3) family",
                                      "date_add(date'2001-01-01', cast(id / 21 as int)) date", "double(id) sales")
    table = stage_bucketed(df, "panel", series.SERIES, ["date"])
    out = series.rolling_features(series.lag_features(table))
    assert "Exchange" not in _executed(out)
    assert out.count() == 2000 and sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))


def test_metric_store_replaces_its_own_rows(spark, tmp_path):
    from shelfcast.sources import sinks

    path = str(tmp_path / "m")
    one = spark.createDataFrame([(1, 0.5), (2, 0.7)], "store_nbr int, rmsle double")
    sinks.append_metrics(one, path, "a")
    sinks.append_metrics(one.selectExpr("*", "9 as extra"), path, "b")
    sinks.append_metrics(one.where("store_nbr = 1"), path, "a")
    rows = sorted((r.model, r.store_nbr, r.extra) for r in sinks.read_store(spark, path).collect())
    assert rows == [("a", 1, None), ("b", 1, 9), ("b", 2, 9)]
    log = str(tmp_path / "log")
    for rmse in (1.0, 2.0):
        sinks.log_experiment(spark, log, "e", "m", {"k": 1}, {"rmse": rmse}, 0.5)
    assert [r.metrics for r in sinks.read_store(spark, log).collect()] == [{"rmse": 2.0}]
