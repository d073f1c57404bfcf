"""The reference's four pipeline fixtures, with their expectations."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import clean, features
from shelfcast.sources.adapter import Sources

D = dt.date


def test_grid_densify(spark):
    train = spark.createDataFrame(
        [(1, D(2013, 1, 1), 1, "A", 10.0, 1), (2, D(2013, 1, 3), 1, "A", 20.0, 2), (3, D(2013, 1, 1), 2, "A", 5.0, 0)],
        "id bigint, date date, store_nbr int, family string, sales double, onpromotion int")
    grid = clean.build_train_grid(train)
    rows = {(r.date, r.store_nbr, r.family): r for r in grid.collect()}
    assert len(rows) == 6
    assert sum(r.is_generated_row for r in rows.values()) == 3
    r = rows[(D(2013, 1, 2), 1, "A")]
    assert (r.sales, r.onpromotion, r.is_generated_row, r.id) == (0.0, 0, 1, None)
    c = clean.grid_counters(train, grid).first()
    assert (c.rows_before, c.rows_after, c.rows_added) == (3, 6, 3)


def test_grid_present_null_sales_is_not_generated(spark):
    train = spark.createDataFrame([(1, D(2013, 1, 1), 1, "A", None, 1)],
                                  "id bigint, date date, store_nbr int, family string, sales double, onpromotion int")
    r = clean.build_train_grid(train).first()
    assert r.sales == 0.0 and r.is_generated_row == 0


def test_oil_interpolation(spark):
    oil = spark.createDataFrame([(D(2013, 1, 1), "90.0"), (D(2013, 1, 3), "96.0")], "date date, dcoilwtico string")
    oil = oil.select("date", F.col("dcoilwtico").try_cast("double").alias("dcoilwtico"))
    span = spark.createDataFrame([(D(2013, 1, 1), D(2013, 1, 3))], "min_date date, max_date date")
    out = {r.date: r for r in clean.clean_oil(oil, span).collect()}
    assert out[D(2013, 1, 2)].oil_price == 93.0
    assert sum(r.oil_missing_original for r in out.values()) == 1
    assert out[D(2013, 1, 1)].oil_price_change_1 == 0.0
    assert out[D(2013, 1, 3)].oil_price_ma_7 == 93.0


def _holiday_tables(spark):
    hol = spark.createDataFrame(
        [(D(2013, 1, 1), "holiday", "national", "ecuador", "new year", False),
         (D(2013, 1, 2), "holiday", "regional", "pichincha", "regional day", False),
         (D(2013, 1, 3), "holiday", "local", "quito", "city day", False)],
        "date date, type string, locale string, locale_name string, description string, transferred boolean")
    stores = spark.createDataFrame([(1, "quito", "pichincha", "d", 13), (2, "guayaquil", "guayas", "d", 13)],
                                   "store_nbr int, city string, state string, type string, cluster int")
    return clean.clean_holidays(hol), stores


def test_holiday_scope(spark):
    hol, stores = _holiday_tables(spark)
    feats = {(r.date, r.store_nbr): r for r in clean.build_holiday_store_features(hol, stores).collect()}
    assert feats[(D(2013, 1, 1), 2)].is_national_holiday == 1
    r = feats[(D(2013, 1, 2), 1)]
    assert r.is_regional_holiday == 1 and "regional day" in r.holiday_names
    assert (D(2013, 1, 2), 2) not in feats  # regional holiday of another state
    assert feats[(D(2013, 1, 3), 1)].is_local_holiday == 1


def test_integrate_and_derive(spark):
    train = spark.createDataFrame([(D(2013, 1, 1), 1, "A", 1, 5.0, 2, 0)],
                                  "date date, store_nbr int, family string, id bigint, sales double, "
                                  "onpromotion int, is_generated_row int")
    test = spark.createDataFrame([(2, D(2013, 1, 2), 1, "A", 0)],
                                 "id bigint, date date, store_nbr int, family string, onpromotion int")
    stores = spark.createDataFrame([(1, "quito", "pichincha", "d", 13)],
                                   "store_nbr int, city string, state string, type string, cluster int")
    oil = spark.createDataFrame(
        [(D(2013, 1, 1), 90.0, 0, 0.0, 90.0, 90.0), (D(2013, 1, 2), 91.0, 0, 1.0, 90.5, 90.5)],
        "date date, oil_price double, oil_missing_original int, oil_price_change_1 double, "
        "oil_price_ma_7 double, oil_price_ma_28 double")
    tx = spark.createDataFrame([(D(2013, 1, 1), 1, 100.0, 0), (D(2013, 1, 2), 1, 80.0, 0)],
                               "date date, store_nbr int, transactions double, transactions_missing_original int")
    hf = spark.createDataFrame([(D(2013, 1, 1), 1, 1, 1, 0, 0, 1, 0, 0, 0, 0, "new year")],
                               "date date, store_nbr int, holiday_count int, is_national_holiday int, "
                               "is_regional_holiday int, is_local_holiday int, is_holiday int, is_event int, "
                               "is_additional int, is_bridge int, is_work_day int, holiday_names string")
    span = spark.createDataFrame([(D(2013, 1, 1), D(2013, 1, 2))], "min_date date, max_date date")
    c = clean.Cleaned(train, test, stores, oil, None, tx, hf, span, Sources(train, test, stores, oil, None, tx))
    integ = features.integrate(c)
    assert len(integ.columns) == 30
    out = features.build_features(integ, span)
    assert out.columns == features.FEATURE_COLUMNS and len(out.columns) == 49
    rows = sorted(out.collect(), key=lambda r: r.date)
    assert len(rows) == 2
    assert [r.promo_active for r in rows] == [1, 0]
    assert [r.family_mean_transactions for r in rows] == [90.0, 90.0]
    assert [r.holiday_name_count for r in rows] == [1, 0]
    assert [r.days_since_start for r in rows] == [0, 1]
    assert rows[1].sales is None and rows[1].dataset_split == "test"
    assert rows[0].store_family_key == "1_A"
