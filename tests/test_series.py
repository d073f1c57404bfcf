"""Series operators and seasonal-naive checks (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import forecast, quality, series


def _daily(spark, n, value=lambda i: float(i % 7 + 1), store=1, family="A"):
    start = dt.date(2015, 1, 1)
    rows = [(start + dt.timedelta(days=i), store, family, value(i)) for i in range(n)]
    return spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")


def test_rolling_origin_inclusive(spark):
    df = _daily(spark, 500)
    out = series.rolling_origin_split(df, 3, 31, 365)
    last = out.where("split = 2")
    val = last.where("is_val").orderBy("date").collect()
    train_end = last.where("is_train").agg(F.max("date")).first()[0]
    assert len(val) == 32 and val[0].date == train_end
    strict = series.rolling_origin_split(df, 3, 31, 365, strict=True).where("split = 2")
    assert strict.where("is_val and is_train").count() == 0
    assert strict.where("is_val").count() == 31


def test_rolling_origin_min_train(spark):
    assert series.rolling_origin_split(_daily(spark, 200), 3, 31, 365).count() == 0


def test_seasonal_naive_periodic_is_exact(spark):
    df = _daily(spark, 28 + 14).withColumn("dataset_split", F.lit("train"))
    first_val = (dt.date(2015, 1, 1) + dt.timedelta(days=28)).isoformat()
    test_start = (dt.date(2015, 1, 1) + dt.timedelta(days=42)).isoformat()
    res = forecast.baseline_backtest(df, first_val, test_start).first()
    assert res.rmsle == 0.0 and res.rmse == 0.0 and res.val_days == 14 and res.train_days == 28


def test_seasonal_naive_short_series_skipped(spark):
    df = _daily(spark, 6 + 5).withColumn("dataset_split", F.lit("train"))
    vs = (dt.date(2015, 1, 1) + dt.timedelta(days=6)).isoformat()
    assert forecast.baseline_backtest(df, vs, "2030-01-01").count() == 0


def test_submission_tiles_and_falls_back(spark):
    train = _daily(spark, 14).withColumn("dataset_split", F.lit("train"))
    short = _daily(spark, 3, store=2).withColumn("dataset_split", F.lit("train"))
    feats = train.unionByName(short)
    test_rows = []
    for s in (1, 2, 3):
        for k in range(16):
            test_rows.append((s * 100 + k, dt.date(2015, 2, 1) + dt.timedelta(days=k), s, "A"))
    test = spark.createDataFrame(test_rows, "id bigint, date date, store_nbr int, family string")
    sub = {r.id: r.sales for r in forecast.submission(feats, test).collect()}
    assert [sub[100 + k] for k in range(8)] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 1.0]
    mean = round(sum([float(i % 7 + 1) for i in range(14)] + [1.0, 2.0, 3.0]) / 17, 2)
    assert sub[200] == mean and len([k for k in sub if k // 100 == 2]) == 16
    assert not any(k // 100 == 3 for k in sub)  # pair absent from train


def test_expanding_folds():
    assert series.expanding_folds(10, 3) == [(0, 4, 6), (1, 6, 8), (2, 8, 10)]


def test_duplicate_null_keys(spark):
    df = spark.createDataFrame([(None, dt.date(2015, 1, 1)), (None, dt.date(2015, 1, 1)), ("a", dt.date(2015, 1, 1))],
                               "k string, date date")
    prof = {(r.metric, r.column_name): r for r in quality.profile_table(df, ["k", "date"]).collect()}
    assert prof[("duplicate_key_rows", "k,date")].value == 1
    assert prof[("missing", "k")].value == 2
    assert prof[("date_min", "date")].text == "2015-01-01"


def test_global_row_index_and_positional_split(spark):
    df = _daily(spark, 10).unionByName(_daily(spark, 10, store=2))
    out = series.positional_split(df, ["date"], 0.8).orderBy("row_index").collect()
    assert [r.row_index for r in out] == list(range(20))
    assert sum(r.split == "train" for r in out) == 16 and out[-1].store_nbr == 2


def test_sequence_windows_stay_inside_series(spark):
    df = _daily(spark, 5).unionByName(_daily(spark, 5, store=2))
    out = series.sequence_windows(df, ["sales"], "sales", 3)
    assert out.count() == 4  # 2 per series, none crossing


def test_global_row_index_matches_total_order(spark):
    import itertools

    rows = [(dt.date(2015, 1, 1) + dt.timedelta(days=d), s, f, 1.0)
            for d, s, f in itertools.product(range(5), (3, 1, 2), ("B", "A"))]
    df = spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")
    for order, partition in ((["store_nbr", "family"], ["date"]), (["date"], ["store_nbr", "family"]),
                             (["store_nbr"], ["family", "date"])):
        got = {(r.date, r.store_nbr, r.family): r.row_index
               for r in series.global_row_index(df, order, partition).collect()}
        key = partition + order
        want = {(r[0], r[1], r[2]): i for i, r in enumerate(
            sorted(rows, key=lambda r: tuple(r[["date", "store_nbr", "family"].index(c)] for c in key)))}
        assert got == want, (order, partition)


def test_profiles_of_empty_tables(spark):
    df = spark.createDataFrame([], "k string, date date")
    table = quality.profile_table(df, ["k"], "s", "t")
    prof = {(r.metric, r.column_name): r for r in table.collect()}
    assert prof[("rows", None)].value == prof[("duplicate_key_rows", "k")].value == prof[("missing", "k")].value == 0
    assert prof[("date_min", "date")].text is None and prof[("rows", None)].table_name == "t"
    plan = table._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rolling_masks_score_as_the_repeated_rows_do(spark):
    """The splits as flags against one backtest for each split's own rows."""
    from shelfcast.functions.metrics import error_aggregates

    rows = [(dt.date(2013, 1, 1) + dt.timedelta(days=i), s, "A", "train", float((i * 7 + s * i * i) % 23))
            for s, n in ((1, 480), (2, 440), (3, 30)) for i in range(n) if (i + s) % 11]
    feats = spark.createDataFrame(rows, "date date, store_nbr int, family string, dataset_split string, sales double")
    for strict in (False, True):
        got = forecast.rolling_validation(feats, 3, 31, 300, strict=strict)
        want = []
        split = series.rolling_origin_split(forecast.training_frame(feats), 3, 31, 300, strict)
        for k in range(3):
            fc, _ = forecast.seasonal_naive(split.where(F.col("split") == k), "is_train", "is_val", "sales")
            want += fc.groupBy("store_nbr").agg(F.min("date").alias("lo"), F.max("date").alias("hi"),
                                                *error_aggregates("sales", "prediction")).selectExpr("*", f"{k} AS split").collect()
        key = lambda r: (r.store_nbr, r.split)
        a, b = sorted(got.collect(), key=key), sorted(want, key=key)
        assert len(a) == len(b) == 6
        for x, y in zip(a, b):
            assert key(x) == key(y) and (x.val_start, x.val_end) == (y.lo, y.hi)
            assert all(abs(x[m] - y[m]) < 1e-9 for m in ("rmsle", "rmse", "mae"))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Aggregate")
