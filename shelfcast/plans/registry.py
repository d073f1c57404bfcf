"""Registered queries: one per inventory operator, each reading the benchmark
tables of ``sf_dir`` and returning a DataFrame. ``ORACLE`` holds the matching
DuckDB SQL for the operators that SQL can express.

Double columns are rounded to 6 decimals on both sides so engine-specific
summation order cannot change the compared values."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array
from pyspark.sql import types as T

from ..checks.duckdb_sql import sql
from ..functions import stats
from ..operators import clean, evaluate, features as feat, forecast, quality, series
from ..operators.boosting import Boosting
from ..session import ensure_checkpoint_dir, input_version, stage
from ..sources import sinks
from ..sources.adapter import load_sources
from ..sources.readers import DEFAULT_FILES, metrics_for_model, read_sources
from .pipeline import TEST_START, VAL_START, pipeline_for, write_run

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None = None, doubles: tuple[str, ...] = (),
             digits: dict[str, int] | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
        if oracle is not None:
            body = oracle.strip()
            if doubles:
                dg = digits or {}
                repl = ", ".join(f"round(round({c}, {dg.get(c, 6)}), 6) AS {c}" for c in doubles)
                body = f"SELECT * REPLACE ({repl}) FROM ({body}) q"
            ORACLE[name] = sql(body)
        return fn
    return deco


def _pipe(spark: SparkSession, sf_dir: str):
    return pipeline_for(spark, sf_dir)


# ------------------------------------------------------------------ sources

@register("s1_raw_train", "SELECT * FROM train_raw", ("sales",))
def q_s1_train(spark, d):
    return load_sources(spark, d).train


@register("s1_raw_test", "SELECT * FROM test_raw")
def q_s1_test(spark, d):
    return load_sources(spark, d).test


@register("s1_raw_stores", "SELECT * FROM stores_raw")
def q_s1_stores(spark, d):
    return load_sources(spark, d).stores


@register("s1_read_csv_train", "SELECT * FROM train_raw", ("sales",))
def q_s1_csv_train(spark, d):
    return read_sources(spark, _as_csv(spark, d)).train


@register("s1_read_csv_holidays", "SELECT * FROM hol_raw")
def q_s1_csv_holidays(spark, d):
    # the raw flag is text in a file; the view has it as a boolean
    return read_sources(spark, _as_csv(spark, d)).holidays.withColumn("transferred", F.col("transferred").cast("boolean"))


def _as_csv(spark, d) -> str:
    """The source views written as the raw CSV files."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex[:12]}"
    for name, df in load_sources(spark, d).as_dict().items():
        sinks.write_table(df, f"{base}/{DEFAULT_FILES[name]}", "csv")
    return base


@register("s7_s8_written_outputs", """
SELECT 'integrated' AS output, COUNT(*) AS n_rows FROM features UNION ALL
SELECT 'features', COUNT(*) FROM features UNION ALL
SELECT 'submission', COUNT(*) FROM test_raw
""")
def q_s7(spark, d):
    p = _pipe(spark, d)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    paths = write_run(spark, p, base)
    paths["submission"] = sinks.write_predictions(forecast.submission(p.features, p.cleaned.test), f"{base}/submission")
    parts = [spark.read.parquet(paths[n]).agg(F.lit(n).alias("output"), F.count(F.lit(1)).alias("n_rows"))
             for n in ("integrated", "features")]
    parts.append(spark.read.option("header", True).csv(paths["submission"]).agg(
        F.lit("submission").alias("output"), F.count(F.lit(1)).alias("n_rows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("s1_raw_oil", "SELECT * FROM oil_raw", ("dcoilwtico",))
def q_s1_oil(spark, d):
    return load_sources(spark, d).oil


@register("s1_raw_holidays", "SELECT * FROM hol_raw")
def q_s1_holidays(spark, d):
    return load_sources(spark, d).holidays


@register("s1_raw_transactions", "SELECT * FROM tx_raw", ("transactions",))
def q_s1_transactions(spark, d):
    return load_sources(spark, d).transactions


@register("s2_train_frame", "SELECT * FROM tf", ("sales",))
def q_s2(spark, d):
    return forecast.training_frame(_pipe(spark, d).features)


@register("s4_head_rows",
          "SELECT * FROM features ORDER BY date, store_nbr, family, dataset_split LIMIT 1000",
          ("sales", "transactions", "oil_price", "oil_price_change_1", "oil_price_ma_7", "oil_price_ma_28",
           "family_mean_onpromotion", "store_mean_onpromotion", "family_mean_transactions",
           "store_mean_transactions"))
def q_s4(spark, d):
    from ..sources.readers import head_rows
    return head_rows(_pipe(spark, d).features, 1000, ["date", "store_nbr", "family", "dataset_split"])


# ----------------------------------------------------------------- cleaning

@register("p1_p4_typed_stores", "SELECT * FROM stores_c")
def q_p4(spark, d):
    return clean.type_sources(load_sources(spark, d)).stores


@register("p6_p7_clean_holidays", "SELECT * FROM hol_c")
def q_p6(spark, d):
    return clean.clean_holidays(clean.type_sources(load_sources(spark, d)).holidays)


@register("g2_train_grid", "SELECT * FROM grid", ("sales",))
def q_g2(spark, d):
    return clean.build_train_grid(clean.type_sources(load_sources(spark, d)).train)


@register("a6_global_span", "SELECT * FROM span")
def q_a6(spark, d):
    t = clean.type_sources(load_sources(spark, d))
    return clean.global_span(t.train, t.test)


@register("g4_w1_w4_clean_oil", "SELECT * FROM oil_c",
          ("oil_price", "oil_price_change_1", "oil_price_ma_7", "oil_price_ma_28"))
def q_g4(spark, d):
    return _pipe(spark, d).cleaned.oil


@register("g3_transactions_frame", "SELECT * FROM tx_c", ("transactions",))
def q_g3(spark, d):
    return _pipe(spark, d).cleaned.transactions


@register("j2_j4_u2_holiday_expansion",
          "SELECT date, store_nbr, holiday_locale, holiday_description FROM hol_exp")
def q_j2(spark, d):
    c = _pipe(spark, d).cleaned
    return clean.expand_holidays_to_stores(c.holidays, c.stores).select(
        "date", "store_nbr", "holiday_locale", "holiday_description")


@register("a1_holiday_store_features", "SELECT * FROM hol_feat")
def q_a1(spark, d):
    return _pipe(spark, d).cleaned.holiday_features


_COUNTERS_SQL = """
SELECT step, metric, CAST(value AS BIGINT) AS value FROM (
SELECT 'train' AS step, 'rows_before' AS metric, (SELECT COUNT(*) FROM train_raw) AS value
UNION ALL SELECT 'train', 'rows_after', (SELECT COUNT(*) FROM grid)
UNION ALL SELECT 'train', 'rows_added', (SELECT SUM(is_generated_row) FROM grid)
UNION ALL SELECT 'oil', 'rows_after_reindex', (SELECT COUNT(*) FROM oil_c)
UNION ALL SELECT 'oil', 'missing_original', (SELECT SUM(oil_missing_original) FROM oil_c)
UNION ALL SELECT 'holidays', 'rows_before', (SELECT COUNT(*) FROM hol_raw)
UNION ALL SELECT 'holidays', 'rows_after', (SELECT COUNT(*) FROM hol_c)
UNION ALL SELECT 'holidays', 'transferred_removed', (SELECT COUNT(*) FROM hol_raw) - (SELECT COUNT(*) FROM hol_c)
UNION ALL SELECT 'transactions', 'rows_after_reindex', (SELECT COUNT(*) FROM tx_c)
UNION ALL SELECT 'transactions', 'missing_original', (SELECT SUM(transactions_missing_original) FROM tx_c))
"""


@register("a4_cleaning_counters", _COUNTERS_SQL)
def q_a4(spark, d):
    return clean.transformation_counters(_pipe(spark, d).cleaned)


# ------------------------------------------------------ integration/features

_INTEG_DOUBLES = ("sales", "oil_price", "oil_price_change_1", "oil_price_ma_7", "oil_price_ma_28", "transactions")
_FEAT_DOUBLES = _INTEG_DOUBLES + ("family_mean_onpromotion", "store_mean_onpromotion",
                                  "family_mean_transactions", "store_mean_transactions")


@register("u1_j8_integrated_dataset", "SELECT * FROM integrated", _INTEG_DOUBLES)
def q_integrated(spark, d):
    return _pipe(spark, d).integrated


@register("t18_feature_dataset", "SELECT * FROM features", _FEAT_DOUBLES)
def q_features(spark, d):
    return _pipe(spark, d).features


@register("w5_group_means", """
SELECT 'family' AS level, family AS key, avg(onpromotion) AS mean_onpromotion, avg(transactions) AS mean_transactions
FROM integrated GROUP BY family
UNION ALL
SELECT 'store', CAST(store_nbr AS VARCHAR), avg(onpromotion), avg(transactions) FROM integrated GROUP BY store_nbr
""", ("mean_onpromotion", "mean_transactions"))
def q_w5(spark, d):
    fam, sto = feat.group_means(_pipe(spark, d).integrated)
    a = fam.select(F.lit("family").alias("level"), F.col("family").alias("key"),
                   F.col("family_mean_onpromotion").alias("mean_onpromotion"),
                   F.col("family_mean_transactions").alias("mean_transactions"))
    b = sto.select(F.lit("store").alias("level"), F.col("store_nbr").cast("string").alias("key"),
                   F.col("store_mean_onpromotion").alias("mean_onpromotion"),
                   F.col("store_mean_transactions").alias("mean_transactions"))
    return a.unionByName(b)


@register("f1_f8_calendar", """
SELECT DISTINCT date, year, quarter, month, day, day_of_week, day_of_year, week_of_year, is_weekend,
  is_month_start, is_month_end, is_quarter_start, is_quarter_end, days_since_start FROM features
""")
def q_calendar(spark, d):
    return _pipe(spark, d).features.select(
        "date", "year", "quarter", "month", "day", "day_of_week", "day_of_year", "week_of_year", "is_weekend",
        "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end", "days_since_start").distinct()


# ------------------------------------------------------------------- quality

def _profile_sql(view: str, columns: list[str], keys: list[str] | None, section: str, table: str) -> str:
    head = f"SELECT '{section}' AS section, '{table}' AS table_name, "
    rows = [head + "'rows' AS metric, CAST(NULL AS VARCHAR) AS column_name, CAST(COUNT(*) AS BIGINT) AS value, "
            f"CAST(NULL AS VARCHAR) AS text FROM {view}"]
    if keys:
        rows.append(head + f"'duplicate_key_rows', '{','.join(keys)}', CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT "
                    f"{', '.join(keys)} FROM {view})) AS BIGINT), NULL FROM {view}")
    rows += [head + f"'column', '{c}', CAST({i} AS BIGINT), NULL" for i, c in enumerate(columns)]
    rows += [head + f"'missing', '{c}', CAST(COUNT(*) - COUNT({c}) AS BIGINT), NULL FROM {view}" for c in columns]
    if "date" in columns:
        rows += [head + f"'{m}', 'date', NULL, strftime({f}(date), '%Y-%m-%d') FROM {view}"
                 for m, f in (("date_min", "MIN"), ("date_max", "MAX"))]
    return "\nUNION ALL\n".join(rows)


_PROFILE_SQL = ("SELECT metric, column_name, value, text FROM ("
                + _profile_sql("features", feat.FEATURE_COLUMNS, quality.OUTPUT_KEYS, "", "") + ") q")


@register("a2_profile_features", _PROFILE_SQL)
def q_a2(spark, d):
    prof = quality.profile_table(_pipe(spark, d).features, keys=quality.OUTPUT_KEYS)
    return prof.select("metric", "column_name", "value", "text")


# ------------------------------------------------------------------- series

@register("t1_time_split", f"""
SELECT date, store_nbr, family, sales,
  CASE WHEN date < DATE '{VAL_START}' THEN 'train' WHEN date < DATE '{TEST_START}' THEN 'val' ELSE 'test' END AS split
FROM tf""", ("sales",))
def q_t1(spark, d):
    return series.time_split(forecast.training_frame(_pipe(spark, d).features), VAL_START, TEST_START)


@register("w6_lag_features", """
SELECT date, store_nbr, family, sales,
  lag(sales, 1) OVER w AS sales_lag_1, lag(sales, 7) OVER w AS sales_lag_7,
  lag(sales, 14) OVER w AS sales_lag_14, lag(sales, 28) OVER w AS sales_lag_28
FROM tf WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)
""", ("sales", "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28"))
def q_w6(spark, d):
    return series.lag_features(forecast.training_frame(_pipe(spark, d).features))


@register("w7_w8_rolling_features", """
SELECT date, store_nbr, family, sales,
  CASE WHEN count(sales) OVER w7 = 7 THEN avg(sales) OVER w7 END AS rolling_mean_7,
  CASE WHEN count(sales) OVER w7 = 7 THEN stddev_samp(sales) OVER w7 END AS rolling_std_7,
  CASE WHEN count(sales) OVER w14 = 14 THEN avg(sales) OVER w14 END AS rolling_mean_14
FROM tf WINDOW w7 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w14 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
""", ("sales", "rolling_mean_7", "rolling_std_7", "rolling_mean_14"))
def q_w7(spark, d):
    return series.rolling_features(forecast.training_frame(_pipe(spark, d).features))


@register("w9_last_season", """
SELECT store_nbr, family, date, sales, CAST(rn AS INTEGER) AS back_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date DESC) AS rn FROM tf) WHERE rn <= 7
""", ("sales",))
def q_w9(spark, d):
    tf = forecast.training_frame(_pipe(spark, d).features)
    rn = F.row_number().over(series.series_window(desc=True))
    return tf.withColumn("back_rank", rn).where(F.col("back_rank") <= 7).select(
        "store_nbr", "family", "date", "sales", "back_rank")


@register("w10_positional_split", """
SELECT store_nbr, family, date, CAST(rn - 1 AS BIGINT) AS row_index,
  CASE WHEN rn - 1 < floor(total * 0.8) THEN 'train' ELSE 'val' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY store_nbr, family, date) AS rn, COUNT(*) OVER () AS total FROM tf)
""")
def q_w10(spark, d):
    tf = forecast.training_frame(_pipe(spark, d).features)
    return series.positional_split(tf, ["date"]).select("store_nbr", "family", "date", "row_index", "split")


@register("w14_test_steps", """
SELECT id, store_nbr, family, date, CAST(row_number() OVER (PARTITION BY store_nbr, family ORDER BY date) AS INTEGER)
  AS step FROM test_raw
""")
def q_w14(spark, d):
    return series.step_numbers(load_sources(spark, d).test).select("id", "store_nbr", "family", "date", "step")


@register("t2_rolling_origin_split", """
WITH b AS (
  SELECT store_nbr, family, k AS split, max_d - CAST((2 - k) * 31 AS INTEGER) AS val_end,
         max_d - CAST((2 - k) * 31 + 31 AS INTEGER) AS val_start
  FROM (SELECT store_nbr, family, MAX(date) AS max_d FROM tf GROUP BY 1, 2), range(0, 3) r(k)),
j AS (
  SELECT t.store_nbr, t.family, CAST(b.split AS INTEGER) AS split, t.date, t.date <= b.val_start AS is_train,
         t.date >= b.val_start AS is_val
  FROM tf t JOIN b ON t.store_nbr = b.store_nbr AND t.family = b.family WHERE t.date <= b.val_end)
SELECT store_nbr, family, split, date, is_train, is_val, n_train FROM (
  SELECT *, COUNT(*) FILTER (WHERE is_train) OVER (PARTITION BY store_nbr, family, split) AS n_train FROM j)
WHERE n_train >= 365
""")
def q_t2(spark, d):
    tf = forecast.training_frame(_pipe(spark, d).features)
    return series.rolling_origin_split(tf).select(
        "store_nbr", "family", "split", "date", "is_train", "is_val", "n_train")


@register("a5_series_list", "SELECT DISTINCT store_nbr, family FROM features WHERE dataset_split = 'train'")
def q_a5(spark, d):
    return series.series_list(_pipe(spark, d).features)


@register("l2_first_n_series", """
SELECT DISTINCT store_nbr, family FROM features WHERE dataset_split = 'train' ORDER BY store_nbr, family LIMIT 20
""")
def q_l2(spark, d):
    return series.first_n_series(_pipe(spark, d).features, 20)


@register("l3_sample_series", """
SELECT store_nbr, family FROM (SELECT DISTINCT store_nbr, family FROM features WHERE dataset_split = 'train')
ORDER BY md5('42|' || CAST(store_nbr AS VARCHAR) || '|' || family), store_nbr, family LIMIT 10
""")
def q_l3(spark, d):
    return series.sample_series(_pipe(spark, d).features, 10, seed=42)


@register("j9_restrict_to_series", """
SELECT t.* FROM tf t SEMI JOIN (
  SELECT DISTINCT store_nbr, family FROM features WHERE dataset_split = 'train' ORDER BY store_nbr, family LIMIT 20
) p ON t.store_nbr = p.store_nbr AND t.family = p.family
""", ("sales",))
def q_j9(spark, d):
    f = _pipe(spark, d).features
    return series.restrict_to_series(forecast.training_frame(f), series.first_n_series(f, 20))


@register("p16_last_n_days", """
SELECT * FROM tf WHERE date > (SELECT MAX(date) FROM tf) - 30
""", ("sales",))
def q_p16(spark, d):
    return series.last_n_days(forecast.training_frame(_pipe(spark, d).features), 30)


# ----------------------------------------------------------------- forecast

_SN_VAL = f"""
WITH tagged AS (
  SELECT *, date < DATE '{VAL_START}' AS is_fit, date >= DATE '{VAL_START}' AND date < DATE '{TEST_START}' AS is_val,
         date >= DATE '{TEST_START}' AS is_test FROM tf),
facts AS (
  SELECT store_nbr, family, COUNT(*) FILTER (WHERE is_fit) AS n_fit, COUNT(*) FILTER (WHERE is_val) AS n_val,
         COUNT(*) FILTER (WHERE is_test) AS n_test FROM tagged GROUP BY 1, 2),
season AS (
  SELECT store_nbr, family, 7 - rn AS pos, sales AS season_value FROM (
    SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date DESC) AS rn
    FROM tagged WHERE is_fit) WHERE rn <= 7),
val AS (
  SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date) AS step FROM tagged WHERE is_val),
fc AS (
  SELECT v.store_nbr, v.family, v.date, v.sales, s.season_value AS prediction, CAST(v.step AS INTEGER) AS step
  FROM val v JOIN facts f ON v.store_nbr = f.store_nbr AND v.family = f.family AND f.n_fit >= 7
  JOIN season s ON v.store_nbr = s.store_nbr AND v.family = s.family AND s.pos = (v.step - 1) % 7)
"""

_METRICS_SQL = """sqrt(avg(pow(ln(1 + {y}) - ln(1 + greatest({p}, 0)), 2))) AS rmsle,
  sqrt(avg(pow({y} - {p}, 2))) AS rmse, avg(abs({y} - {p})) AS mae"""


@register("t3_seasonal_naive_forecasts",
          _SN_VAL + "SELECT store_nbr, family, date, sales, prediction, step FROM fc", ("sales", "prediction"))
def q_t3(spark, d):
    tf = forecast.training_frame(_pipe(spark, d).features)
    dd = F.col("date")
    vs, ts = F.lit(VAL_START).cast("date"), F.lit(TEST_START).cast("date")
    tagged = tf.withColumns({"_fit": dd < vs, "_val": (dd >= vs) & (dd < ts)})
    fc, _ = forecast.seasonal_naive(tagged, "_fit", "_val", "sales", 7)
    return fc.select("store_nbr", "family", "date", "sales", "prediction", F.col("_step").cast("int").alias("step"))


_T4_SQL = _SN_VAL + f"""
, res AS (
SELECT m.store_nbr, m.family, m.rmsle, m.rmse, m.mae, f.n_fit AS train_days, f.n_val AS val_days,
       f.n_test AS test_days
FROM (SELECT store_nbr, family, {_METRICS_SQL.format(y='sales', p='prediction')} FROM fc GROUP BY 1, 2) m
JOIN facts f ON m.store_nbr = f.store_nbr AND m.family = f.family WHERE f.n_fit > 0 AND f.n_val > 0)
"""


@register("t4_baseline_backtest", _T4_SQL + "SELECT * FROM res", ("rmsle", "rmse", "mae"))
def q_t4(spark, d):
    return forecast.baseline_backtest(_pipe(spark, d).features, VAL_START, TEST_START)


@register("a16_backtest_summary", _T4_SQL + """
SELECT COUNT(*) AS n_sequences, avg(rmsle) AS rmsle_mean, quantile_cont(rmsle, 0.5) AS rmsle_median,
  stddev_samp(rmsle) AS rmsle_std, avg(rmse) AS rmse_mean, avg(mae) AS mae_mean FROM res
""", ("rmsle_mean", "rmsle_median", "rmsle_std", "rmse_mean", "mae_mean"))
def q_a16(spark, d):
    return forecast.backtest_summary(forecast.baseline_backtest(_pipe(spark, d).features, VAL_START, TEST_START))


_T5_SQL = """
WITH b AS (
  SELECT store_nbr, family, k AS split, max_d - CAST((2 - k) * 31 AS INTEGER) AS val_end,
         max_d - CAST((2 - k) * 31 + 31 AS INTEGER) AS val_start
  FROM (SELECT store_nbr, family, MAX(date) AS max_d FROM tf GROUP BY 1, 2), range(0, 3) r(k)),
j AS (
  SELECT t.store_nbr, t.family, CAST(b.split AS INTEGER) AS split, t.date, t.sales,
         t.date <= b.val_start AS is_train, t.date >= b.val_start AS is_val
  FROM tf t JOIN b ON t.store_nbr = b.store_nbr AND t.family = b.family WHERE t.date <= b.val_end),
jn AS (SELECT * FROM (SELECT *, COUNT(*) FILTER (WHERE is_train)
       OVER (PARTITION BY store_nbr, family, split) AS n_train FROM j) WHERE n_train >= 365),
season AS (
  SELECT store_nbr, family, split, 7 - rn AS pos, sales AS season_value FROM (
    SELECT *, row_number() OVER (PARTITION BY store_nbr, family, split ORDER BY date DESC) AS rn
    FROM jn WHERE is_train) WHERE rn <= 7),
val AS (SELECT *, row_number() OVER (PARTITION BY store_nbr, family, split ORDER BY date) AS step
        FROM jn WHERE is_val),
fc AS (SELECT v.*, s.season_value AS prediction FROM val v JOIN season s
       ON v.store_nbr = s.store_nbr AND v.family = s.family AND v.split = s.split AND s.pos = (v.step - 1) % 7),
per_split AS (
  SELECT f.store_nbr, f.family, f.split, t.train_end, f.val_start, f.val_end, f.rmsle, f.rmse, f.mae FROM (
    SELECT store_nbr, family, split, MIN(date) AS val_start, MAX(date) AS val_end,
      """ + _METRICS_SQL.format(y="sales", p="prediction") + """
    FROM fc GROUP BY 1, 2, 3) f
  JOIN (SELECT store_nbr, family, split, MAX(date) AS train_end FROM jn WHERE is_train GROUP BY 1, 2, 3) t
    ON f.store_nbr = t.store_nbr AND f.family = t.family AND f.split = t.split)
"""


@register("t5_rolling_validation", _T5_SQL + "SELECT * FROM per_split", ("rmsle", "rmse", "mae"))
def q_t5(spark, d):
    return forecast.rolling_validation(_pipe(spark, d).features)


@register("t5_rolling_validation_summary", _T5_SQL + """
SELECT store_nbr, family, COUNT(*) AS n_splits, avg(rmsle) AS rmsle_mean, avg(rmse) AS rmse_mean,
  avg(mae) AS mae_mean FROM per_split GROUP BY 1, 2
""", ("rmsle_mean", "rmse_mean", "mae_mean"))
def q_t5s(spark, d):
    return forecast.rolling_summary(forecast.rolling_validation(_pipe(spark, d).features))


_T6_SQL = """
WITH facts AS (SELECT store_nbr, family, COUNT(*) AS n_fit FROM tf GROUP BY 1, 2),
season AS (
  SELECT store_nbr, family, 7 - rn AS pos, sales AS season_value FROM (
    SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date DESC) AS rn FROM tf) WHERE rn <= 7),
steps AS (SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date) AS step FROM test_raw),
sub AS (
  SELECT s.id, round(x.season_value, 2) AS sales FROM steps s
  JOIN facts f ON s.store_nbr = f.store_nbr AND s.family = f.family AND f.n_fit >= 7
  JOIN season x ON s.store_nbr = x.store_nbr AND s.family = x.family AND x.pos = (s.step - 1) % 7
  UNION ALL
  SELECT s.id, round((SELECT avg(sales) FROM tf), 2) FROM steps s
  JOIN facts f ON s.store_nbr = f.store_nbr AND s.family = f.family AND f.n_fit > 0 AND f.n_fit < 7)
"""


@register("t6_submission", _T6_SQL + "SELECT * FROM sub", ("sales",))
def q_t6(spark, d):
    p = _pipe(spark, d)
    return forecast.submission(p.features, p.cleaned.test)


@register("a22_global_mean", "SELECT avg(sales) AS global_mean FROM tf", ("global_mean",))
def q_a22(spark, d):
    return forecast.global_mean(forecast.training_frame(_pipe(spark, d).features))


@register("t15_holiday_frame", """
SELECT description AS holiday, date AS ds, 0 AS lower_window, 0 AS upper_window,
  CASE WHEN lower(trim(locale)) = 'local' THEN CAST(0.5 AS DOUBLE) END AS scale
FROM hol_raw WHERE lower(trim(regexp_replace(type, '\\s+', ' ', 'g'))) <> 'work day' AND NOT transferred
""", ("scale",))
def q_t15(spark, d):
    return forecast.prophet_holiday_frame(load_sources(spark, d).holidays)


# --------------------------------------------------------------- evaluation

_PRED_SQL = _T6_SQL + """
, pairs AS (
  SELECT a.date, a.store_nbr, a.family, s.sales AS prediction, a.sales AS actual
  FROM sub s JOIN test_full a ON s.id = a.id)
"""


def _pairs(spark, d) -> DataFrame:
    p = _pipe(spark, d)
    sub = forecast.submission(p.features, p.cleaned.test)
    pred = evaluate.test_with_predictions(p.sources.test, sub, None)
    return evaluate.pair_with_actuals(pred.where(F.col("predicted_sales").isNotNull()), p.sources.test_actuals)


@register("j13_prediction_actual_pairs", _PRED_SQL + "SELECT * FROM pairs", ("prediction", "actual"))
def q_j13(spark, d):
    return _pairs(spark, d)


@register("j10_test_predictions_stores", _PRED_SQL + """
SELECT t.id, t.date, t.store_nbr, t.family, t.onpromotion, s.sales AS predicted_sales, st.city, st.state, st.type,
  st.cluster FROM test_raw t LEFT JOIN sub s ON t.id = s.id LEFT JOIN stores_raw st ON t.store_nbr = st.store_nbr
""", ("predicted_sales",))
def q_j10(spark, d):
    p = _pipe(spark, d)
    sub = forecast.submission(p.features, p.cleaned.test)
    return evaluate.test_with_predictions(p.sources.test, sub, p.sources.stores)


@register("a14_metrics_by_family", _PRED_SQL + """
SELECT family, sqrt(avg(pow(ln(1 + actual) - ln(1 + greatest(prediction, 0)), 2))) AS rmsle,
  sqrt(avg(pow(actual - greatest(prediction, 0), 2))) AS rmse, avg(abs(actual - greatest(prediction, 0))) AS mae
FROM pairs GROUP BY family
""", ("rmsle", "rmse", "mae"))
def q_a14(spark, d):
    return evaluate.metric_table(_pairs(spark, d), ["family"], clip="pred")


@register("a15_extended_metrics", _PRED_SQL + """
, c AS (SELECT greatest(actual, 0) AS y, greatest(prediction, 0) AS p FROM pairs)
SELECT sqrt(avg(pow(ln(1 + y) - ln(1 + p), 2))) AS rmsle, avg(abs(y - p)) AS mae, sqrt(avg(pow(y - p, 2))) AS rmse,
  CASE WHEN var_pop(y) * COUNT(y) > 0 THEN 1 - SUM(pow(y - p, 2)) / (var_pop(y) * COUNT(y))
       WHEN SUM(pow(y - p, 2)) = 0 THEN 1.0 ELSE 0.0 END AS r2,
  avg(abs((y - p) / (y + 1e-8))) * 100 AS mape FROM c
""", ("rmsle", "mae", "rmse", "r2", "mape"), {"rmsle": 4, "mae": 4, "rmse": 4, "r2": 4, "mape": 2})
def q_a15(spark, d):
    m = evaluate.extended_metric_table(_pairs(spark, d))
    # the original reports metrics at 4 decimals and MAPE at 2
    return m.select(*[F.round(c, 2 if c == "mape" else 4).alias(c) for c in m.columns])


@register("a8_daily_sales", "SELECT date, SUM(sales) AS total FROM tf GROUP BY date", ("total",))
def q_a8(spark, d):
    return evaluate.daily_total(forecast.training_frame(_pipe(spark, d).features))


@register("a8_daily_predictions", _T6_SQL + """
SELECT t.date, SUM(s.sales) AS total FROM sub s JOIN test_raw t ON s.id = t.id GROUP BY t.date
""", ("total",))
def q_a8p(spark, d):
    p = _pipe(spark, d)
    sub = forecast.submission(p.features, p.cleaned.test)
    pred = evaluate.test_with_predictions(p.sources.test, sub, None).where(F.col("predicted_sales").isNotNull())
    return evaluate.daily_total(pred, "predicted_sales")


@register("a9_top_stores", """
SELECT store_nbr, SUM(sales) AS total FROM tf GROUP BY store_nbr ORDER BY total DESC, store_nbr LIMIT 20
""", ("total",))
def q_a9s(spark, d):
    return evaluate.top_n(forecast.training_frame(_pipe(spark, d).features), "store_nbr", "sales", 20)


@register("a9_top_families", """
SELECT family, SUM(sales) AS total FROM tf GROUP BY family ORDER BY total DESC, family LIMIT 15
""", ("total",))
def q_a9f(spark, d):
    return evaluate.top_n(forecast.training_frame(_pipe(spark, d).features), "family", "sales", 15)


@register("a10_store_family_means", """
WITH cell AS (SELECT store_nbr, family, avg(sales) AS mean_value FROM tf GROUP BY 1, 2),
top AS (SELECT family FROM cell GROUP BY family ORDER BY SUM(mean_value) DESC, family LIMIT 10)
SELECT * FROM cell WHERE family IN (SELECT family FROM top)
""", ("mean_value",))
def q_a10(spark, d):
    return evaluate.mean_matrix_long(forecast.training_frame(_pipe(spark, d).features))


@register("a12_best_worst_families", _T4_SQL + """
, means AS (SELECT family, avg(rmsle) AS mean_metric FROM res GROUP BY family)
SELECT 'best' AS side, CAST(row_number() OVER (ORDER BY mean_metric, family) AS INTEGER) AS rank, family, mean_metric
FROM means QUALIFY rank <= 5
UNION ALL
SELECT 'worst', CAST(row_number() OVER (ORDER BY mean_metric DESC, family) AS INTEGER), family, mean_metric
FROM means QUALIFY row_number() OVER (ORDER BY mean_metric DESC, family) <= 5
""", ("mean_metric",))
def q_a12(spark, d):
    return evaluate.best_worst(forecast.baseline_backtest(_pipe(spark, d).features, VAL_START, TEST_START))


@register("a17_prediction_histogram", _T6_SQL + """
, st AS (SELECT MIN(sales) AS lo, MAX(sales) AS hi, avg(sales) AS mean_value FROM sub),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((sales - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER)
      AS bin, lo, hi, mean_value FROM sub, st WHERE sales IS NOT NULL)
SELECT bin, lo + (bin - 1) * (hi - lo) / 50 AS bin_start, COUNT(*) AS count, any_value(mean_value) AS mean_value
FROM b GROUP BY bin, lo, hi
""", ("bin_start", "mean_value"))
def q_a17(spark, d):
    p = _pipe(spark, d)
    return evaluate.histogram(forecast.submission(p.features, p.cleaned.test), "sales", 50)


@register("a19_box_by_store_type", _PRED_SQL + """
, j AS (SELECT p.*, st.type FROM pairs p JOIN stores_c st ON p.store_nbr = st.store_nbr),
q AS (SELECT type, quantile_cont(prediction, 0.25) AS q1, quantile_cont(prediction, 0.5) AS median,
      quantile_cont(prediction, 0.75) AS q3 FROM j GROUP BY type)
SELECT q.type, q.q1, q.median, q.q3,
  MIN(CASE WHEN j.prediction >= q.q1 - 1.5 * (q.q3 - q.q1) THEN j.prediction END) AS whisker_low,
  MAX(CASE WHEN j.prediction <= q.q3 + 1.5 * (q.q3 - q.q1) THEN j.prediction END) AS whisker_high,
  COUNT(*) FILTER (WHERE j.prediction < q.q1 - 1.5 * (q.q3 - q.q1) OR j.prediction > q.q3 + 1.5 * (q.q3 - q.q1))
    AS outliers
FROM j JOIN q ON j.type = q.type GROUP BY q.type, q.q1, q.median, q.q3
""", ("q1", "median", "q3", "whisker_low", "whisker_high"))
def q_a19(spark, d):
    p = _pipe(spark, d)
    pairs = _pairs(spark, d).join(p.cleaned.stores.select("store_nbr", "type"), "store_nbr")
    # predictions are whole units here, so exact quartiles keep a small buffer
    return evaluate.box_stats(pairs, "type", "prediction")


@register("p24_residuals", _PRED_SQL + """
SELECT date, store_nbr, family, prediction, actual, prediction - actual AS residual FROM pairs
""", ("prediction", "actual", "residual"))
def q_p24(spark, d):
    return evaluate.with_residual(_pairs(spark, d))


@register("p23_prediction_band", _PRED_SQL + """
SELECT date, store_nbr, family, prediction, actual, prediction - abs(prediction) * 0.1 AS lower,
  prediction + abs(prediction) * 0.1 AS upper FROM pairs
""", ("prediction", "actual", "lower", "upper"))
def q_p23(spark, d):
    return evaluate.with_band(_pairs(spark, d), "prediction", 0.1)


@register("p14_series_slice", """
SELECT date, sales, onpromotion, oil_price, transactions, is_holiday, is_event FROM features
WHERE store_nbr = 1 AND family = 'ECONOMY' AND dataset_split = 'train'
""", ("sales", "oil_price", "transactions"))
def q_p14(spark, d):
    return series.series_slice(_pipe(spark, d).features, 1, "ECONOMY")


@register("p15_filtered_history", """
SELECT date, SUM(sales) AS total FROM tf WHERE store_nbr = 1 AND date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
GROUP BY date
""", ("total",))
def q_p15(spark, d):
    tf = forecast.training_frame(_pipe(spark, d).features)
    return evaluate.daily_total(evaluate.filter_history(tf, store_nbr=1, date_from="2000-01-01", date_to="2000-12-31"))


# Model comparison: seasonal naive with weekly and fortnightly seasons, both
# scored per series on the validation month (a metrics table of two models).

def _model_metrics(spark, d) -> DataFrame:
    f = _pipe(spark, d).features
    out = None
    for pos, (name, period) in enumerate([("SeasonalNaive7", 7), ("SeasonalNaive14", 14)]):
        res = forecast.baseline_backtest(f, VAL_START, TEST_START, period)
        m = res.agg(F.avg("rmsle").alias("rmsle"), F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse")).select(
            F.lit(name).alias("model"), F.lit(pos).alias("position"), "rmsle", "mae", "rmse")
        out = m if out is None else out.unionByName(m)
    return out


def _sn_sql(period: int, name: str, pos: int) -> str:
    return f"""
SELECT '{name}' AS model, {pos} AS position, avg(rmsle) AS rmsle, avg(mae) AS mae, avg(rmse) AS rmse FROM (
  SELECT store_nbr, family, {_METRICS_SQL.format(y='sales', p='prediction')} FROM (
    SELECT v.store_nbr, v.family, v.sales, s.sales AS prediction FROM (
      SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date) AS step FROM tf
      WHERE date >= DATE '{VAL_START}' AND date < DATE '{TEST_START}') v
    JOIN (SELECT store_nbr, family, {period} - row_number() OVER (PARTITION BY store_nbr, family ORDER BY date DESC)
          AS pos, sales, COUNT(*) OVER (PARTITION BY store_nbr, family) AS n
          FROM tf WHERE date < DATE '{VAL_START}' QUALIFY row_number() OVER
          (PARTITION BY store_nbr, family ORDER BY date DESC) <= {period}) s
      ON v.store_nbr = s.store_nbr AND v.family = s.family AND s.pos = (v.step - 1) % {period} AND s.n >= {period})
  GROUP BY 1, 2)"""


_MODELS_SQL = f"WITH mm AS ({_sn_sql(7, 'SeasonalNaive7', 0)} UNION ALL {_sn_sql(14, 'SeasonalNaive14', 1)})\n"


@register("a23_t17_metric_comparison", _MODELS_SQL + """
SELECT model, metric, value FROM mm UNPIVOT (value FOR metric IN (rmsle, mae, rmse))
""", ("value",))
def q_a23(spark, d):
    return evaluate.metrics_long(_model_metrics(spark, d))


@register("a21_radar_normalized", _MODELS_SQL + """
, l AS (SELECT model, metric, value FROM mm UNPIVOT (value FOR metric IN (rmsle, mae, rmse)))
SELECT model, metric, value, CASE WHEN max(value) OVER (PARTITION BY metric) = 0 THEN 0.0
  ELSE value / max(value) OVER (PARTITION BY metric) END AS normalized FROM l
""", ("value", "normalized"))
def q_a21(spark, d):
    return evaluate.radar_normalized(_model_metrics(spark, d))


@register("l5_best_model", _MODELS_SQL + """
SELECT arg_min(model, (rmsle, position)) AS best_model, MIN(rmsle) AS best_rmsle FROM mm
""", ("best_rmsle",))
def q_l5(spark, d):
    return evaluate.best_model(_model_metrics(spark, d))


# --------------------------------------------------------------------- ML

_CAT_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS index
FROM (SELECT DISTINCT {c} FROM features WHERE dataset_split = 'train' AND sales IS NOT NULL
      AND date < DATE '{TEST_START}')""" for c in ("family", "city", "state", "type"))


@register("f12_one_hot_vocabulary", _CAT_SQL)
def q_f12(spark, d):
    from ..operators import ml
    rows = ml.model_rows(_pipe(spark, d).features, TEST_START)
    _, cat = ml.feature_columns(rows)
    stages, _ = ml.one_hot_stages(cat)
    from pyspark.ml import Pipeline
    return ml.vocabulary(Pipeline(stages=stages).fit(rows), spark)


# Feature columns that are text, and so not scaled.
_TEXT = {"family", "city", "state", "type"}
_NUMERIC = [c for c in feat.FEATURE_COLUMNS
            if c not in _TEXT | {"id", "date", "dataset_split", "sales", "holiday_names", "store_family_key", "store_nbr"}]


@register("f13_minmax_scaling", f"""
WITH m AS (SELECT * FROM features WHERE dataset_split = 'train' AND sales IS NOT NULL AND date < DATE '{TEST_START}'),
b AS (SELECT {', '.join(f'MIN({c}) lo_{c}, MAX({c}) hi_{c}' for c in _NUMERIC)} FROM m WHERE date < DATE '{VAL_START}')
SELECT date, store_nbr, family,
  {', '.join(f'CAST(({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1.0 ELSE hi_{c} - lo_{c} END AS DOUBLE) AS {c}' for c in _NUMERIC)}
FROM m, b
""", tuple(_NUMERIC))
def q_f13(spark, d):
    from ..operators import ml
    rows = ml.model_rows(_pipe(spark, d).features, TEST_START).select(
        "date", "store_nbr", "family", *(F.col(c).cast("double").alias(c) for c in _NUMERIC))
    return ml.minmax_scale(rows, _NUMERIC, F.col("date") < F.lit(VAL_START).cast("date"))


@register("t9_lag_training_frame", """
SELECT * FROM (
SELECT store_nbr, family, date, sales, onpromotion, CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(month(date) AS INTEGER) AS month,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
  CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
  lag(sales, 1) OVER w AS sales_lag_1, lag(sales, 7) OVER w AS sales_lag_7,
  lag(sales, 14) OVER w AS sales_lag_14, lag(sales, 28) OVER w AS sales_lag_28,
  CASE WHEN count(sales) OVER w7 = 7 THEN avg(sales) OVER w7 END AS rolling_mean_7,
  CASE WHEN count(sales) OVER w7 = 7 THEN stddev_samp(sales) OVER w7 END AS rolling_std_7,
  CASE WHEN count(sales) OVER w14 = 14 THEN avg(sales) OVER w14 END AS rolling_mean_14
FROM (SELECT date, store_nbr, family, COALESCE(TRY_CAST(sales AS DOUBLE), 0.0) AS sales, onpromotion
      FROM features WHERE dataset_split = 'train') tr
WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date),
  w7 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  w14 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
WHERE sales_lag_28 IS NOT NULL AND rolling_mean_14 IS NOT NULL AND rolling_std_7 IS NOT NULL
""", ("sales", "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28", "rolling_mean_7", "rolling_std_7",
      "rolling_mean_14"))
def q_t9(spark, d):
    from ..operators import ml
    return ml.lag_training_frame(_train_rows(spark, d))


def _train_rows(spark, d):
    """Training rows with their promotion counts."""
    f = _pipe(spark, d).features.where(F.col("dataset_split") == "train")
    return f.select("date", "store_nbr", "family", F.coalesce(F.col("sales").try_cast("double"), F.lit(0.0)).alias("sales"), "onpromotion")


@register("w11_expanding_folds", """
SELECT store_nbr, family, date, CAST(rn - 1 AS BIGINT) AS row_index,
  CASE WHEN rn - 1 >= n - (n // 6) * 5 THEN CAST((rn - 1 - (n - (n // 6) * 5)) // (n // 6) AS INTEGER) END AS test_fold
FROM (SELECT store_nbr, family, date, row_number() OVER (ORDER BY store_nbr, family, date) AS rn,
             COUNT(*) OVER () AS n FROM tf)
""")
def q_w11(spark, d):
    tf = forecast.training_frame(_pipe(spark, d).features)
    return series.fold_assignment(tf, 5, ["date"]).select("store_nbr", "family", "date", "row_index", "test_fold")


# Model-fitting queries. The original's depth and rounds; the rounds that were
# fitted are in the results. A model is fitted once for the input and saved.
GBT = Boosting(rounds=300, depth=8)


def _matrix(spark, d):
    """The model matrix of the feature table, written once per input."""
    from ..operators import ml
    key = (spark.sparkContext.applicationId, d, input_version(spark, d))
    if key not in _MATRICES:
        matrix, model, names = ml.prepare_tabular(_pipe(spark, d).features, VAL_START, TEST_START)
        kept = matrix.select("date", "store_nbr", "family", "features", "label", "is_val")
        _MATRICES[key] = (stage(kept, "matrix"), model, names)
    return _MATRICES[key]


def _gbt_fit(spark, d):
    from ..operators import ml
    matrix, model, names = _matrix(spark, d)
    trees = ml.saved_model(spark, ("gbt", input_version(spark, d), GBT), lambda: ml.fit_gbt(matrix, GBT))
    return matrix, model, names, trees


_MATRICES: dict = {}


@register("t8_tabular_matrix", f"""
WITH m AS (SELECT * FROM features WHERE dataset_split = 'train' AND sales IS NOT NULL AND date < DATE '{TEST_START}'),
w AS (SELECT {' + '.join(f'COUNT(DISTINCT {c}) + 1' for c in sorted(_TEXT))} + {len(_NUMERIC) + 1} AS n_features FROM m)
SELECT date >= DATE '{VAL_START}' AS is_val, COUNT(*) AS n_rows, SUM(sales) AS sum_label,
  CAST(any_value(n_features) AS INTEGER) AS n_features,
  SUM({' + '.join(f'CAST({c} AS DOUBLE)' for c in ("onpromotion", "store_nbr", "day_of_year", "is_holiday", "days_since_start"))}) AS sum_some
FROM m, w GROUP BY 1
""", ("sum_label", "sum_some"))
def q_t8(spark, d):
    from ..operators import ml
    matrix, _, names = ml.prepare_tabular(_pipe(spark, d).features, VAL_START, TEST_START)
    some = ["onpromotion", "store_nbr", "day_of_year", "is_holiday", "days_since_start"]
    value = vector_to_array("features")
    return matrix.groupBy("is_val").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("sum_label"), F.lit(len(names)).alias("n_features"),
        F.sum(sum((value[names.index(c)] for c in some[1:]), value[names.index(some[0])])).alias("sum_some"))


@register("t10_gbt_metrics")
def q_t10(spark, d):
    from ..operators import ml
    matrix, _, _, m = _gbt_fit(spark, d)
    return ml.split_metrics(m, matrix)


@register("t10_watch_log")
def q_t10_watch(spark, d):
    from ..operators import ml
    return ml.watch_log(_gbt_fit(spark, d)[3], spark)


# The lag trainer's own settings.
LAG_TRAINER = Boosting(rounds=500, depth=10)


@register("t9_lag_trainer_metrics")
def q_t9_trainer(spark, d):
    """One-hot lag frame, positional 80/20 split, boosted trees, both metric rows."""
    from ..operators import ml
    matrix, _, _ = ml.lag_matrix(ml.lag_training_frame(_train_rows(spark, d)))
    matrix = stage(matrix.select(*series.SERIES, "date", "features", "label", "is_val"), "lag-matrix")
    trees = ml.saved_model(spark, ("lag trainer", input_version(spark, d), LAG_TRAINER), lambda: ml.fit_gbt(matrix, LAG_TRAINER))
    return ml.split_metrics(trees, matrix)


@register("t11_l4_split_importance")
def q_t11(spark, d):
    from ..operators import ml
    _, _, names, m = _gbt_fit(spark, d)
    return ml.top_features(ml.split_count_importance(m, names, spark), 20)


@register("t16_gbt_test_predictions")
def q_t16(spark, d):
    from ..operators import ml
    _, model, _, m = _gbt_fit(spark, d)
    return ml.score_test(_pipe(spark, d).features, model, m)


# Horizon of the test split (days); scoring lags start here.
_HORIZON = 16
_LAG_COLS = ("sales_lag_16", "sales_lag_22", "sales_lag_29", "sales_lag_43",
             "rolling_mean_7", "rolling_mean_14", "rolling_std_7")


@register("u3_t9_scoring_frame", """
WITH u AS (
  SELECT store_nbr, family, date, CAST(sales AS DOUBLE) AS sales, CAST(NULL AS BIGINT) AS id
  FROM features WHERE dataset_split = 'train'
  UNION ALL
  SELECT store_nbr, family, date, CAST(NULL AS DOUBLE), id FROM features WHERE dataset_split = 'test'),
f AS (
  SELECT id, store_nbr, family, date, sales,
    CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(month(date) AS INTEGER) AS month,
    CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
    CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
    lag(sales, 16) OVER w AS sales_lag_16, lag(sales, 22) OVER w AS sales_lag_22,
    lag(sales, 29) OVER w AS sales_lag_29, lag(sales, 43) OVER w AS sales_lag_43,
    CASE WHEN count(sales) OVER w7 = 7 THEN avg(sales) OVER w7 END AS rolling_mean_7,
    CASE WHEN count(sales) OVER w14 = 14 THEN avg(sales) OVER w14 END AS rolling_mean_14,
    CASE WHEN count(sales) OVER w7 = 7 THEN stddev_samp(sales) OVER w7 END AS rolling_std_7
  FROM u WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date),
    w7 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 22 PRECEDING AND 16 PRECEDING),
    w14 AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 29 PRECEDING AND 16 PRECEDING))
SELECT * FROM f WHERE id IS NOT NULL AND sales_lag_16 IS NOT NULL AND sales_lag_22 IS NOT NULL
  AND sales_lag_29 IS NOT NULL AND sales_lag_43 IS NOT NULL AND rolling_mean_7 IS NOT NULL
  AND rolling_mean_14 IS NOT NULL AND rolling_std_7 IS NOT NULL
""", ("sales",) + _LAG_COLS)
def q_u3(spark, d):
    from ..operators import ml
    return ml.scoring_frame(_pipe(spark, d).features, _HORIZON)


@register("t16_lag_model_predictions")
def q_t16_lag(spark, d):
    from ..operators import ml
    feats = _pipe(spark, d).features
    trees = ml.saved_model(spark, ("lags", input_version(spark, d), GBT, _HORIZON),
                           lambda: ml.fit_lag_model(feats, VAL_START, _HORIZON, GBT)[0])
    return ml.score_lag_model(trees, feats, _HORIZON)


@register("t7_param_search")
def q_t7(spark, d):
    from ..operators import ml
    grid = [replace(GBT, depth=depth) for depth in (4, 6, 8)]
    return ml.param_search(_matrix(spark, d)[0], grid, n_splits=5)


@register("t12_sequence_regression")
def q_t12(spark, d):
    from ..operators import ml
    f = _pipe(spark, d).features.where(F.col("dataset_split") == "train").where(
        F.col("date") < F.lit(TEST_START).cast("date"))
    # window features exclude the target, as in the original matrix
    cols = _NUMERIC
    frame = f.select("store_nbr", "family", "date", F.col("sales").cast("double").alias("sales"),
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    ds = ml.sequence_dataset(frame, cols, VAL_START, 14)
    model = ml.sequence_regression(ds)
    pred = model.transform(ds).withColumn("split", F.when(F.col("is_val"), "validation").otherwise("train"))
    return ml.evaluate_predictions(pred, "split")


# Orders with at most one lag, whose least squares SQL has as regr_slope.
_ONE_LAG_ORDERS = [(p, d, P, D) for p, P in ((0, 0), (1, 0), (0, 1)) for d in (0, 1) for D in (0, 1)]


def _order_fits_sql() -> str:
    """The AIC search over ``_ONE_LAG_ORDERS`` on the common sample."""
    def z(k: int, d: int, D: int) -> str:
        terms = {k: 1}
        for step in [1] * d + [7] * D:
            terms = {j: terms.get(j, 0) - terms.get(j - step, 0) for j in {*terms, *(j + step for j in terms)}}
        return "(" + " + ".join(f"({c}) * y{j}" for j, c in sorted(terms.items())) + ")"

    fits = []
    for pos, (p, d, P, D) in enumerate(_ONE_LAG_ORDERS):
        z0, zk = z(0, d, D), z(7 if P else 1, d, D)
        if p + P:
            slope = f"coalesce(regr_slope({z0}, {zk}), 0.0)"
            rss = f"var_pop({z0}) * count(*) - pow({slope}, 2) * var_pop({zk}) * count(*)"
        else:
            slope, rss = "0.0", f"var_pop({z0}) * count(*)"
        fits.append(f"SELECT store_nbr, family, {pos} AS position, {p} AS p, {d} AS d, {P} AS P_s, {D} AS D_s, count(*) AS n, "
                    f"avg({z0}) - {slope} * avg({zk}) AS intercept, {slope} AS slope, "
                    f"greatest({rss}, 1e-12 * sum(y0 * y0), 1e-12) AS rss FROM lagged GROUP BY 1, 2")
    return (f"WITH h AS (SELECT store_nbr, family, date, sales - avg(sales) OVER (PARTITION BY store_nbr, family) AS y0 "
            f"FROM tf WHERE date < DATE '{VAL_START}'), "
            f"lagged AS (SELECT * FROM (SELECT *, {', '.join(f'lag(y0, {k}) OVER w AS y{k}' for k in range(1, 16))} FROM h "
            "WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)) WHERE y15 IS NOT NULL), "
            f"fits AS ({' UNION ALL '.join(fits)}), "
            "scored AS (SELECT *, n * ln(rss / n) + 2 * (1 + p + P_s) AS aic FROM fits WHERE n > 2 + p + P_s) "
            "SELECT store_nbr, family, p, d, P_s, D_s, n, intercept, slope, aic, "
            "row_number() OVER (PARTITION BY store_nbr, family ORDER BY aic, position) = 1 AS best FROM scored")


@register("t13_order_search", _order_fits_sql(), ("intercept", "slope", "aic"))
def q_t13_orders(spark, d):
    from ..operators import models
    tf = forecast.training_frame(_pipe(spark, d).features)
    fits = stage(models.order_fits(models.lag_moments(tf, VAL_START, TEST_START, grid=_ONE_LAG_ORDERS), grid=_ONE_LAG_ORDERS), "order-fits")
    best = models.best_orders(fits).select("store_nbr", "family", F.col("position").alias("_best"))
    return fits.where(F.col("aic").isNotNull()).join(best, ["store_nbr", "family"]).select(
        "store_nbr", "family", "p", "d", "P_s", "D_s", "n", F.col("coef")[0].alias("intercept"),
        F.coalesce(F.get("coef", F.lit(1)), F.lit(0.0)).alias("slope"), "aic", (F.col("position") == F.col("_best")).alias("best"))


@register("t13_seasonal_ar_forecasts")
def q_t13(spark, d):
    from ..operators import models
    tf = forecast.training_frame(_pipe(spark, d).features)
    fc = models.sarima_forecasts(tf, VAL_START, TEST_START)
    return models.forecast_metrics(fc, tf)


def _additive_rows(spark, d) -> DataFrame:
    """Train rows with their date's raw oil price (J12), the additive model's
    input for history and future alike."""
    from ..operators import models
    p = _pipe(spark, d)
    rows = p.features.where(F.col("dataset_split") == "train").select(
        "date", "store_nbr", "family", "sales", "onpromotion", "transactions")
    return models.future_frame(rows, p.sources.oil)


@register("j12_future_frame_with_oil", f"""
SELECT f.date, f.store_nbr, f.family, f.onpromotion, o.dcoilwtico FROM features f
LEFT JOIN (SELECT date, avg(dcoilwtico) AS dcoilwtico FROM oil_raw GROUP BY date) o ON f.date = o.date
WHERE f.dataset_split = 'train' AND f.date >= DATE '{VAL_START}' AND f.date < DATE '{TEST_START}'
""", ("dcoilwtico",))
def q_j12(spark, d):
    val = (F.col("date") >= F.lit(VAL_START).cast("date")) & (F.col("date") < F.lit(TEST_START).cast("date"))
    return _additive_rows(spark, d).where(val).select("date", "store_nbr", "family", "onpromotion", "dcoilwtico")


def _additive(spark, d) -> DataFrame:
    from ..operators import models
    return models.additive_forecasts(_additive_rows(spark, d), VAL_START, TEST_START, ("onpromotion", "dcoilwtico", "transactions"),
                                     holiday_frame=forecast.prophet_holiday_frame(_pipe(spark, d).sources.holidays))


@register("t14_additive_forecasts")
def q_t14(spark, d):
    return _additive(spark, d).select("store_nbr", "family", "date", "yhat", "yhat_lower", "yhat_upper")


_LINE_SQL = f"""
WITH h AS (SELECT store_nbr, family, count(*) AS n, regr_slope(sales, x) AS b, regr_intercept(sales, x) AS a,
  greatest(sqrt((var_pop(sales) - pow(regr_slope(sales, x), 2) * var_pop(x))), 1e-6 * greatest(max(abs(sales)), 1)) AS sd,
  avg(x) AS mx, var_pop(x) AS vx
  FROM (SELECT *, date - DATE '2000-01-01' AS x FROM tf WHERE date < DATE '{VAL_START}') GROUP BY 1, 2 HAVING count(*) >= 14),
f AS (SELECT store_nbr, family, date, date - DATE '2000-01-01' AS x FROM tf
  WHERE date >= DATE '{VAL_START}' AND date < DATE '{TEST_START}'),
p AS (SELECT f.store_nbr, f.family, f.date, a + b * x AS v,
  1.96 * sd * sqrt(1 + 1.0 / n + pow(x - mx, 2) / (n * vx)) AS half
  FROM f JOIN h ON f.store_nbr = h.store_nbr AND f.family = h.family)
"""


@register("t14_straight_line", _LINE_SQL + """
SELECT store_nbr, family, date, greatest(v, 0) AS yhat, greatest(v - half, 0) AS yhat_lower, greatest(v + half, 0) AS yhat_upper FROM p
""", ("yhat", "yhat_lower", "yhat_upper"))
def q_t14_line(spark, d):
    """The model with its trend alone: a straight line and its prediction band."""
    from ..operators import models
    tf = forecast.training_frame(_pipe(spark, d).features)
    line = models.additive_forecasts(tf, VAL_START, TEST_START, (), n_changepoints=0, weekly_order=0, yearly_order=0)
    return line.select("store_nbr", "family", "date", "yhat", "yhat_lower", "yhat_upper")


def _naive(tf: DataFrame) -> DataFrame:
    d, vs, ts = F.col("date"), F.lit(VAL_START).cast("date"), F.lit(TEST_START).cast("date")
    tagged = tf.withColumns({"_fit": d < vs, "_val": (d >= vs) & (d < ts)})
    frame = forecast.seasonal_naive_frame(tagged, "_fit", "_val", "sales")
    return frame.where(F.col("prediction").isNotNull()).select(
        "store_nbr", "family", "date", F.col("prediction").alias("yhat"), F.lit("seasonal_naive").alias("order_label"))


def _compared(spark, d, fits: dict) -> DataFrame:
    from .compare import train_and_compare
    tf = forecast.training_frame(_pipe(spark, d).features)
    store = f"{ensure_checkpoint_dir(spark).rstrip('/')}/compare-{uuid.uuid4().hex[:12]}"
    long, best = train_and_compare(spark, {"SeasonalNaive7": lambda: _naive(tf), **fits}, tf, store)
    return long.crossJoin(F.broadcast(best)).select("model", "metric", "value", (F.col("model") == F.col("best_model")).alias("best"))


@register("t17_train_and_compare_line", _LINE_SQL + f"""
, per AS (SELECT store_nbr, family, {_METRICS_SQL.format(y='t.sales', p='greatest(p.v, 0)')}
  FROM p JOIN tf t USING (store_nbr, family, date) GROUP BY 1, 2),
mm AS ({_sn_sql(7, 'SeasonalNaive7', 0)}
  UNION ALL SELECT 'StraightLine', 1, avg(rmsle), avg(mae), avg(rmse) FROM per)
SELECT model, metric, value, model = (SELECT arg_min(model, (rmsle, position)) FROM mm) AS best
FROM (SELECT * FROM mm) UNPIVOT (value FOR metric IN (rmsle, mae, rmse))
""", ("value",))
def q_t17_line(spark, d):
    """Two models that SQL can express, trained and compared."""
    from ..operators import models
    tf = forecast.training_frame(_pipe(spark, d).features)
    return _compared(spark, d, {"StraightLine": lambda: models.additive_forecasts(
        tf, VAL_START, TEST_START, (), n_changepoints=0, weekly_order=0, yearly_order=0)})


@register("t17_train_and_compare")
def q_t17(spark, d):
    """Seasonal naive, seasonal autoregression and the additive model."""
    from ..operators import models
    tf = forecast.training_frame(_pipe(spark, d).features)
    return _compared(spark, d, {"SeasonalAR": lambda: models.sarima_forecasts(tf, VAL_START, TEST_START),
                                "Additive": lambda: _additive(spark, d)})


@register("a18_density_curve", _T6_SQL + """
, st AS (SELECT MIN(sales) AS lo, MAX(sales) AS hi, stddev_samp(sales) AS sd, COUNT(sales) AS n FROM sub),
fine AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(floor((sales - lo) / (hi - lo) * 2048) + 1, 2048) END AS b,
  COUNT(*) AS c, avg(sales) AS x0 FROM sub, st WHERE sales IS NOT NULL GROUP BY 1),
grid AS (SELECT lo + (hi - lo) * i / 199.0 AS x, sd * pow(n, -0.2) AS h, n FROM st, range(200) r(i))
SELECT x, SUM(c * exp(-0.5 * pow((x - x0) / h, 2)) / (h * sqrt(2 * 3.141592653589793))) / any_value(n) AS density
FROM grid, fine GROUP BY x
""", ("x", "density"))
def q_a18(spark, d):
    p = _pipe(spark, d)
    return evaluate.density_curve(forecast.submission(p.features, p.cleaned.test), "sales")


def _poly_sql(coefs: list[float], x: str) -> str:
    out = f"({coefs[0]!r})::DOUBLE"
    for c in coefs[1:]:
        out = f"({out} * {x} + ({c!r})::DOUBLE)"
    return out


_NORMAL_SQL = f"""
CASE WHEN p < {stats._P_LOW!r} THEN {_poly_sql(stats._C, "sqrt(-2 * ln(p))")} / ({_poly_sql(stats._D, "sqrt(-2 * ln(p))")} * sqrt(-2 * ln(p)) + 1)
  WHEN p > 1 - {stats._P_LOW!r}::DOUBLE
  THEN -{_poly_sql(stats._C, "sqrt(-2 * ln(1 - p))")} / ({_poly_sql(stats._D, "sqrt(-2 * ln(1 - p))")} * sqrt(-2 * ln(1 - p)) + 1)
  ELSE {_poly_sql(stats._A, "((p - 0.5) * (p - 0.5))")} * (p - 0.5) / ({_poly_sql(stats._B, "((p - 0.5) * (p - 0.5))")} * ((p - 0.5) * (p - 0.5)) + 1) END
"""


@register("a20_qq_points", _PRED_SQL + f"""
, q AS (SELECT quantile_cont(prediction - actual, [(i + 0.5::DOUBLE) / 99 FOR i IN range(99)]) AS q FROM pairs),
s AS (SELECT CAST(i AS INTEGER) AS i, (i + 0.5::DOUBLE) / 99 AS p, q[i + 1] AS sample_quantile FROM q, range(99) r(i))
SELECT i, p, sample_quantile, {_NORMAL_SQL} AS theoretical_quantile FROM s
""", ("p", "sample_quantile", "theoretical_quantile"))
def q_a20(spark, d):
    return evaluate.qq_points(evaluate.with_residual(_pairs(spark, d)), "residual")


@register("w12_sequence_windows", """
SELECT store_nbr, family, date, target, sales_sum, sales_first, sales_last, promo_sum, promo_first, promo_last FROM (
SELECT store_nbr, family, date, sales AS target, COUNT(*) OVER w AS n,
  SUM(sales) OVER w AS sales_sum, lag(sales, 14) OVER o AS sales_first, lag(sales, 1) OVER o AS sales_last,
  CAST(SUM(onpromotion) OVER w AS DOUBLE) AS promo_sum, CAST(lag(onpromotion, 14) OVER o AS DOUBLE) AS promo_first,
  CAST(lag(onpromotion, 1) OVER o AS DOUBLE) AS promo_last
FROM (SELECT date, store_nbr, family, COALESCE(TRY_CAST(sales AS DOUBLE), 0.0) AS sales, onpromotion
      FROM features WHERE dataset_split = 'train') tr
WINDOW o AS (PARTITION BY store_nbr, family ORDER BY date),
  w AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)) WHERE n = 14
""", ("target", "sales_sum", "sales_first", "sales_last", "promo_sum", "promo_first", "promo_last"))
def q_w12(spark, d):
    win = series.sequence_windows(_train_rows(spark, d), ["sales", "onpromotion"], "sales", 14)

    def seen(name: str, k: int):
        values = F.transform("window", lambda x: x[k].cast("double"))
        return {f"{name}_sum": F.aggregate(values, F.lit(0.0), lambda a, x: a + x),
                f"{name}_first": F.element_at(values, 1), f"{name}_last": F.element_at(values, -1)}

    return win.withColumns({**seen("sales", 0), **seen("promo", 1)}).drop("window")


# The report's tables in SQL: view, columns in order.
_RAW_TABLES = {
    "train": ("train_raw", "id date store_nbr family sales onpromotion"),
    "test": ("test_raw", "id date store_nbr family onpromotion"),
    "stores": ("stores_raw", "store_nbr city state type cluster"),
    "oil": ("oil_raw", "date dcoilwtico"),
    "holidays": ("hol_raw", "date type locale locale_name description transferred"),
    "transactions": ("tx_raw", "date store_nbr transactions"),
}
_CLEAN_TABLES = {
    "train": ("grid", "date store_nbr family id sales onpromotion is_generated_row"),
    "test": ("test_raw", "id date store_nbr family onpromotion"),
    "oil": ("oil_c", "date oil_price oil_missing_original oil_price_change_1 oil_price_ma_7 oil_price_ma_28"),
    "holidays": ("hol_c", "date type locale locale_name description transferred holiday_type holiday_locale holiday_description "
                          "is_holiday is_event is_additional is_bridge is_work_day"),
    "transactions": ("tx_c", "date store_nbr transactions transactions_missing_original"),
    "holiday_features": ("hol_feat", "date store_nbr holiday_count is_national_holiday is_regional_holiday is_local_holiday "
                                     "is_holiday is_event is_additional is_bridge is_work_day holiday_names"),
}
_REPORT_SQL = "\nUNION ALL\n".join(
    [_profile_sql(v, c.split(), quality.RAW_KEYS[k], "raw_tables", k) for k, (v, c) in _RAW_TABLES.items()]
    + [_profile_sql(v, c.split(), quality.CLEAN_KEYS[k], "cleaned_tables", k) for k, (v, c) in _CLEAN_TABLES.items()]
    + [_profile_sql("integrated", feat.INTEGRATED_COLUMNS, quality.OUTPUT_KEYS, "outputs", "integrated_dataset"),
       _profile_sql("features", feat.FEATURE_COLUMNS, quality.OUTPUT_KEYS, "outputs", "feature_dataset"),
       f"SELECT 'transformations', step, metric, NULL, value, NULL FROM ({_COUNTERS_SQL}) c"])


@register("a3_quality_report", _REPORT_SQL)
def q_a3(spark, d):
    p = _pipe(spark, d)
    c = p.cleaned
    cleaned = {"train": c.train, "test": c.test, "oil": c.oil, "holidays": c.holidays,
               "transactions": c.transactions, "holiday_features": c.holiday_features}
    return quality.quality_report(p.sources.as_dict(), cleaned, p.integrated, p.features,
                                  clean.transformation_counters(c))


@register("a11_metric_matrix", _T4_SQL + """
, fam AS (SELECT family FROM res GROUP BY family ORDER BY avg(rmsle), family LIMIT 15),
sto AS (SELECT DISTINCT store_nbr FROM res WHERE family IN (SELECT family FROM fam) ORDER BY store_nbr LIMIT 15)
SELECT store_nbr, family, avg(rmsle) AS value FROM res
WHERE family IN (SELECT family FROM fam) AND store_nbr IN (SELECT store_nbr FROM sto) GROUP BY 1, 2
""", ("value",))
def q_a11(spark, d):
    return evaluate.metric_matrix_long(forecast.baseline_backtest(_pipe(spark, d).features, VAL_START, TEST_START))


@register("a7_oil_from_features", "SELECT DISTINCT date, oil_price FROM features", ("oil_price",))
def q_a7(spark, d):
    return _pipe(spark, d).features.select("date", "oil_price").dropDuplicates(["date"])


@register("a13_validation_metrics", _MODELS_SQL + """
SELECT model, rmsle, mae, rmse FROM mm
""", ("rmsle", "mae", "rmse"))
def q_a13(spark, d):
    # per-series rows of two seasonal-naive runs form the metrics table; the
    # validation metric of a model is the mean over its series (no split rows)
    f = _pipe(spark, d).features
    parts = []
    for name, period in [("SeasonalNaive7", 7), ("SeasonalNaive14", 14)]:
        res = forecast.baseline_backtest(f, VAL_START, TEST_START, period)
        parts.append(res.select(F.lit(name).alias("model"), F.lit(None).cast("string").alias("split"),
                                "rmsle", "mae", "rmse"))
    return evaluate.validation_metrics(parts[0].unionByName(parts[1]))


@register("p22_model_frame", """
SELECT date AS ds, sales AS y, CAST(onpromotion AS DOUBLE) AS onpromotion, oil_price,
  CAST(0.0 AS DOUBLE) AS dcoilwtico_lag FROM features WHERE dataset_split = 'train'
""", ("y", "onpromotion", "oil_price", "dcoilwtico_lag"))
def q_p22(spark, d):
    return evaluate.model_frame(_pipe(spark, d).features.where(F.col("dataset_split") == "train"),
                                ["onpromotion", "oil_price", "dcoilwtico_lag"])


# ------------------------------------------------------------- metric store

def _sn_rows(period: int, name: str) -> str:
    """The per-series rows that ``_sn_sql`` averages."""
    text = _sn_sql(period, name, 0)
    inner = text[text.index("FROM (") + len("FROM (") : text.rindex(")")]
    return f"SELECT '{name}' AS model, * FROM ({inner})"


@register("s6_s11_metric_store", f"""
WITH r AS ({_sn_rows(7, 'SeasonalNaive7')} UNION ALL {_sn_rows(14, 'SeasonalNaive14')})
SELECT model, store_nbr, family, rmsle, rmse, mae, CASE WHEN model = 'SeasonalNaive14' THEN 14 END AS season_days FROM r
""", ("rmsle", "rmse", "mae"))
def q_metric_store(spark, d):
    """Two models' rows in one store, each written twice, the second model with
    a column that the first lacks; read back by model."""
    f = _pipe(spark, d).features
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/metrics-{uuid.uuid4().hex[:12]}"
    weekly = stage(forecast.baseline_backtest(f, VAL_START, TEST_START, 7).select("store_nbr", "family", "rmsle", "rmse", "mae"), "weekly")
    longer = forecast.baseline_backtest(f, VAL_START, TEST_START, 14).select("store_nbr", "family", "rmsle", "rmse", "mae", F.lit(14).alias("season_days"))
    sinks.append_metrics(weekly.limit(1), path, "SeasonalNaive7")  # an earlier, shorter run
    for name, rows in (("SeasonalNaive7", weekly), ("SeasonalNaive14", stage(longer, "longer"))):
        for _ in range(2):
            sinks.append_metrics(rows, path, name)
    store = sinks.read_store(spark, path)
    both = metrics_for_model(store, "SeasonalNaive7").unionByName(metrics_for_model(store, "SeasonalNaive14"))
    return both.select("model", "store_nbr", "family", "rmsle", "rmse", "mae", "season_days")


@register("s9_experiment_log", _T4_SQL + """
SELECT 'backtest' AS experiment, 'seasonal_naive' AS model, '7' AS period, metric, value FROM (
  SELECT avg(rmsle) AS rmsle, avg(mae) AS mae, avg(rmse) AS rmse FROM res) UNPIVOT (value FOR metric IN (rmsle, mae, rmse))
""", ("value",))
def q_experiment_log(spark, d):
    """An experiment logged twice is one record."""
    res = forecast.baseline_backtest(_pipe(spark, d).features, VAL_START, TEST_START)
    found = res.agg(*[F.avg(c).alias(c) for c in ("rmsle", "mae", "rmse")]).first().asDict()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/experiments-{uuid.uuid4().hex[:12]}"
    for _ in range(2):
        sinks.log_experiment(spark, path, "backtest", "seasonal_naive", {"period": 7}, found, 1.0)
    log = sinks.read_store(spark, path)
    return log.select("experiment", "model", F.col("params")["period"].alias("period"), F.explode("metrics").alias("metric", "value"))


@register("a9_top_families_predicted", _PRED_SQL + """
SELECT family, SUM(prediction) AS total FROM pairs GROUP BY family ORDER BY total DESC, family LIMIT 10
""", ("total",))
def q_a9_predicted(spark, d):
    return evaluate.top_n(_pairs(spark, d), "family", "prediction", 10)


@register("a17_residual_histogram", _PRED_SQL + """
, v AS (SELECT prediction - actual AS r FROM pairs),
st AS (SELECT MIN(r) AS lo, MAX(r) AS hi, avg(r) AS m FROM v),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((r - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin, lo, hi, m FROM v, st)
SELECT bin, any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 50 AS bin_start, COUNT(*) AS count, any_value(m) AS mean_value
FROM b GROUP BY bin
""", ("bin_start", "mean_value"))
def q_a17_residual(spark, d):
    return evaluate.histogram(evaluate.with_residual(_pairs(spark, d)), "residual")


@register("a19_box_top_families", """
WITH j AS (SELECT family, COALESCE(TRY_CAST(sales AS DOUBLE), 0.0) AS sales FROM features WHERE dataset_split = 'train'),
top AS (SELECT family FROM j GROUP BY family ORDER BY SUM(sales) DESC, family LIMIT 3),
k AS (SELECT * FROM j WHERE family IN (SELECT family FROM top)),
q AS (SELECT family, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.5) AS median, quantile_cont(sales, 0.75) AS q3 FROM k GROUP BY family)
SELECT q.family, q.q1, q.median, q.q3,
  MIN(CASE WHEN k.sales >= q.q1 - 1.5 * (q.q3 - q.q1) THEN k.sales END) AS whisker_low,
  MAX(CASE WHEN k.sales <= q.q3 + 1.5 * (q.q3 - q.q1) THEN k.sales END) AS whisker_high,
  COUNT(*) FILTER (WHERE k.sales < q.q1 - 1.5 * (q.q3 - q.q1) OR k.sales > q.q3 + 1.5 * (q.q3 - q.q1)) AS outliers
FROM k JOIN q ON k.family = q.family GROUP BY q.family, q.q1, q.median, q.q3
""", ("q1", "median", "q3", "whisker_low", "whisker_high"))
def q_a19_top(spark, d):
    return evaluate.box_stats(evaluate.top_groups(_train_rows(spark, d), "family", "sales", 3), "family", "sales")


_FAMILIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@register("l6_store_family_matrix", f"""
SELECT store_nbr, {', '.join(f"avg(sales) FILTER (family = '{x}') AS {x}" for x in _FAMILIES)}
FROM (SELECT store_nbr, family, COALESCE(TRY_CAST(sales AS DOUBLE), 0.0) AS sales FROM features WHERE dataset_split = 'train')
GROUP BY store_nbr ORDER BY store_nbr LIMIT 20
""", _FAMILIES)
def q_l6(spark, d):
    """The first 20 stores of the store x family matrix, wide."""
    return evaluate.pivot_matrix(evaluate.mean_matrix_long(_train_rows(spark, d))).orderBy("store_nbr").limit(20)
