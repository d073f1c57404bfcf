"""Model operators: closed-form checks on synthetic series (FIXTURES.md
section 3 style): AR recovery, holiday effect, fixed one-hot vocabulary."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from shelfcast.operators import boosting, ml, models
from shelfcast.operators.boosting import Boosting


def _series(spark, values, store=1, family="A", extra=None):
    start = dt.date(2015, 1, 1)
    rows = []
    for i, v in enumerate(values):
        r = [start + dt.timedelta(days=i), store, family, float(v)]
        if extra is not None:
            r += [float(x) for x in extra[i]]
        rows.append(tuple(r))
    schema = "date date, store_nbr int, family string, sales double"
    if extra is not None:
        schema += ", is_holiday double"
    return spark.createDataFrame(rows, schema)


def _brute_force_order(y, order, s, loss):
    """Least squares of one order on the rows after the first ``loss``."""
    p, d, P, D = order
    z = y.astype(float)
    for step in [s] * D + [1] * d:
        z = z[step:] - z[:-step]
    lags = list(range(1, p + 1)) + [s * k for k in range(1, P + 1)]
    at = np.arange(loss, len(y)) - (len(y) - len(z))
    X = np.column_stack([np.ones(len(at))] + [z[at - lag] for lag in lags])
    coef, *_ = np.linalg.lstsq(X, z[at], rcond=None)
    rss = np.sum((z[at] - X @ coef) ** 2)
    return coef, rss, len(at) * np.log(rss / len(at)) + 2 * X.shape[1]


def test_orders_solved_from_lag_moments_equal_least_squares(spark):
    rng = np.random.default_rng(4)
    y = 500 + np.cumsum(rng.normal(0, 3, 150)) + np.tile(rng.normal(0, 20, 7), 22)[:150]
    df = _series(spark, y).unionByName(_series(spark, y[:20], store=2))
    fits = models.order_fits(models.lag_moments(df, "2030-01-01", "2030-02-01"))
    rows = fits.collect()
    assert len(rows) == 2 * len(models.ORDER_GRID)
    best = {}
    for r in rows:
        if r.store_nbr == 2:  # five rows of the common sample: the larger orders are not fitted
            assert r.n == 5 and (r.aic is None) == (1 + r.p + r.P_s >= 4)
            continue
        order = (r.p, r.d, r.P_s, r.D_s)
        coef, rss, aic = _brute_force_order(y - y.mean(), order, 7, 15)
        assert r.n == 135 and np.allclose(r.coef, coef, atol=1e-6) and abs(r.rss / rss - 1) < 1e-8 and abs(r.aic - aic) < 1e-6
        best[order] = aic
    got = models.best_orders(fits).where("store_nbr = 1").first()
    assert (got.p, got.d, got.P_s, got.D_s) == min(best, key=best.get)


def test_paths_follow_the_differenced_recursion():
    """Forecast and spread of the polynomial recursion against differencing,
    recursing and summing up again by hand."""
    rng = np.random.default_rng(1)
    y = np.cumsum(rng.normal(0, 1, 40))
    coef = np.array([[0.3, 0.5, -0.2]])
    fc, sd = models.forecast_paths(y[None, -16:], coef, (1, 1, 1, 1), np.array([2.0]), 9, 7)
    z = y[7:] - y[:-7]
    z, full = list(z[1:] - z[:-1]), list(y)
    for _ in range(9):
        z.append(0.3 + 0.5 * z[-1] - 0.2 * z[-7])
        full.append(z[-1] + full[-1] + full[-7] - full[-8])
    assert np.allclose(fc[0], full[40:])
    walk = models.forecast_paths(y[None, -16:], np.array([[0.0]]), (0, 1, 0, 0), np.array([1.0]), 9, 7)[1]
    assert np.allclose(walk[0], np.sqrt(np.arange(1, 10))) and abs(sd[0, 0] - 2.0) < 1e-12 and (np.diff(sd[0]) > 0).all()


def test_sarima_forecasts_all_series(spark):
    y = np.tile(np.array([1.0, 5.0, 2.0, 8.0, 3.0, 9.0, 4.0]), 10)
    df = _series(spark, y).unionByName(_series(spark, np.full(70, 3.0), store=2))
    fc = models.sarima_forecasts(df, "2015-02-26", "2015-03-12")
    out = {r.store_nbr: r for r in models.forecast_metrics(fc, df).collect()}
    assert out[1].rmse < 1e-6 and out[2].model == "seasonal_naive" and out[2].rmse == 0.0


def test_additive_model_recovers_holiday_effect(spark):
    n = 400
    hol = np.zeros(n)
    hol[::13] = 1.0
    y = 50 + 20 * hol
    df = _series(spark, y, extra=[[h] for h in hol])
    vs = (dt.date(2015, 1, 1) + dt.timedelta(days=360)).isoformat()
    fc = models.additive_forecasts(df, vs, "2030-01-01", regressors=(), holidays=("is_holiday",))
    j = fc.join(df, ["store_nbr", "family", "date"]).select("yhat", "sales").collect()
    err = max(abs(r.yhat - r.sales) for r in j)
    assert err < 0.2  # 1 % of the effect


def test_additive_model_follows_a_trend_break(spark):
    n = 400
    t = np.arange(n)
    y = 100 + 0.5 * np.maximum(t - 200, 0) + 30 * (np.array([(dt.date(2015, 1, 1) + dt.timedelta(days=int(i))).weekday() for i in t]) == 5)
    df = _series(spark, y)
    vs = (dt.date(2015, 1, 1) + dt.timedelta(days=380)).isoformat()
    fc = models.additive_forecasts(df, vs, "2030-01-01", regressors=(), holidays=())
    j = fc.join(df, ["store_nbr", "family", "date"]).select("yhat", "sales").collect()
    assert len(j) == 20 and max(abs(r.yhat - r.sales) / r.sales for r in j) < 0.01


def test_named_holidays_have_their_own_effect_and_prior(spark):
    """Two names on different days get their own sizes; the local one is held
    closer to zero by its smaller prior. A day with both adds them up."""
    rng = np.random.default_rng(3)
    n, start = 400, dt.date(2015, 1, 1)
    y = 100 + rng.normal(0, 2, n)
    fair, feast = [50, 150, 250, 385], [90, 190, 290, 390]
    y[fair] += 30
    y[feast] += 30
    both = 395
    y[both] += 60
    day = lambda i: start + dt.timedelta(days=i)
    rows = [("Fair", day(i), 0.5) for i in fair + [both]] + [("Feast", day(i), None) for i in feast + [both]]
    hol = spark.createDataFrame(rows + [(None, day(5), None), ("Unseen", day(398), None)], "holiday string, ds date, scale double")
    args = dict(regressors=(), holiday_frame=hol, n_changepoints=0, weekly_order=0, yearly_order=0)
    df = _series(spark, y)
    wide = {r.date: r.yhat for r in models.additive_forecasts(df, day(380).isoformat(), "2030-01-01", **args).collect()}
    assert len(wide) == 20 and abs(wide[day(385)] - 130) < 5 and abs(wide[day(390)] - 130) < 5 and abs(wide[day(both)] - 160) < 8
    assert abs(wide[day(398)] - 100) < 2  # a holiday that the history does not have changes nothing
    tight = {r.date: r.yhat for r in models.additive_forecasts(df, day(380).isoformat(), "2030-01-01", holiday_scale=0.02, **args).collect()}
    assert 100 < tight[day(385)] < tight[day(390)] < 130


def test_additive_bands_widen_with_the_horizon(spark):
    t = np.arange(400)
    y = 200 + 0.8 * np.abs(t % 160 - 80) + np.random.default_rng(8).normal(0, 2, 400)
    vs = (dt.date(2015, 1, 1) + dt.timedelta(days=340)).isoformat()
    fc = models.additive_forecasts(_series(spark, y), vs, "2030-01-01", regressors=(), weekly_order=0, yearly_order=0)
    half = [r.yhat_upper - r.yhat for r in fc.orderBy("date").collect()]
    assert len(half) == 60 and (np.diff(half) > 0).all() and half[-1] > 1.5 * half[0]
    # Steps of size b at a rate r: simulated variance of the trend against the closed form.
    rng = np.random.default_rng(0)
    rate, b, ahead = 30.0, 0.2, 0.5
    sums = [sum((ahead - u) * rng.laplace(0, b) for u in rng.uniform(0, ahead, rng.poisson(rate * ahead))) for _ in range(20000)]
    assert abs(np.var(sums) / models.trend_break_variance(np.full(9, b), np.array([ahead]), rate)[0] - 1) < 0.1


def test_future_frame_keeps_every_row(spark):
    day = dt.date(2015, 1, 1)
    oil = spark.createDataFrame([(day, 40.0), (day, 50.0)], "date date, dcoilwtico double")
    got = models.future_frame(_series(spark, [1.0, 2.0]), oil).orderBy("date").collect()
    assert [r.dcoilwtico for r in got] == [45.0, None]


def _matrix(spark, n=400, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:, 2] = x[:, 2] > 0
    y = x[:, 0] * x[:, 1] + 3 * x[:, 2] + 5 + rng.normal(0, 0.1, n)
    rows = [([float(v) for v in r], float(t), i >= n * 3 // 4) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "features array<double>, label double, is_val boolean")


def test_boosted_trees_keep_every_round(spark, tmp_path):
    m = _matrix(spark)
    model = ml.fit_gbt(m, Boosting(rounds=40, depth=3, rate=0.2))
    assert model.n_trees == 40
    log = ml.watch_log(model, spark).orderBy("round").collect()
    assert [r.round for r in log] == list(range(1, 41)) and log[-1].validation_rmse < 0.5 * log[0].validation_rmse
    # The stored trees give the predictions that the rounds ended with.
    loaded = boosting.BoostedTrees.load(spark, model.save(spark, str(tmp_path / "m")))
    assert loaded.params == model.params and loaded.watch == model.watch
    for trees in (model, loaded):
        got = trees.transform(m).groupBy("is_val").agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("e"))
        errors = {r.is_val: r.e for r in got.collect()}
        assert abs(errors[False] - log[-1].train_rmse) < 1e-4 and abs(errors[True] - log[-1].validation_rmse) < 1e-4


def test_boosted_trees_on_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 90)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 6)
    monkeypatch.setattr(boosting, "REPLAYED", 4)
    m = _matrix(spark, 1200)
    blocks = boosting.make_blocks(m.withColumn("c", F.col("is_val").cast("int")), "features", "label", "c")
    sizes = [r["rows"] for r in blocks.table.collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 90 and len(sizes) > 10
    deep, shallow = boosting.fit_many(blocks, [(Boosting(rounds=60, depth=4, rate=0.2), 0), (Boosting(rounds=20, depth=1), 0)])
    assert (deep.n_trees, shallow.n_trees, len(deep.watch), len(shallow.watch)) == (60, 20, 60, 20)
    assert deep.watch[-1][1] < 0.6 < shallow.watch[-1][1]
    sle = deep.transform(m.where("is_val")).agg(F.sqrt(F.avg(F.pow(F.log1p("label") - F.log1p(F.greatest("prediction", F.lit(0.0))), 2)))).first()[0]
    assert abs(sle - deep.test_rmsle) < 1e-4


def test_split_search_finds_the_best_split():
    rng = np.random.default_rng(5)
    binned = rng.integers(0, 6, (4, 300)).astype(np.uint8)
    g = rng.normal(size=300) + (binned[2] > 3) * 2 - (binned[1] > 1)
    p = Boosting(depth=2, row_sample=1.0, column_sample=1.0, l1=0.1, l2=1.0)

    def best(rows):
        def score(part):
            return max(abs(g[part].sum()) - p.l1, 0) ** 2 / (len(part) + p.l2)

        options = [(score(rows[binned[f, rows] <= b]) + score(rows[binned[f, rows] > b]) - score(rows), -f, -b)
                   for f in range(4) for b in range(5) if 0 < (binned[f, rows] <= b).sum() < len(rows)]
        _, f, b = max(options)
        return -f, -b

    t = boosting.grow(binned, g, np.full(4, 6), p, np.random.default_rng(0))
    rows = np.arange(300)
    assert (t.feature[0], t.bin[0]) == best(rows) and t.split.all()
    right = binned[t.feature[0]] > t.bin[0]
    for child, part in ((1, rows[~right]), (2, rows[right])):
        assert (t.feature[child], t.bin[child]) == best(part)


def test_missing_values_and_constant_labels(spark):
    rows = [([float(i % 5), None if i % 3 == 0 else 1.0], float(10 * (i % 3 == 0)), False) for i in range(200)]
    df = spark.createDataFrame(rows, "features array<double>, label double, is_val boolean")
    model = ml.fit_gbt(df, Boosting(rounds=80, depth=2, rate=0.3, column_sample=1.0))
    assert max(abs(r.prediction - r.label) for r in model.transform(df).collect()) < 0.5
    same = ml.fit_gbt(df.withColumn("label", F.lit(4.0)), Boosting(rounds=3, depth=2))
    assert {r.prediction for r in same.transform(df).collect()} == {4.0}


def test_vocabulary_fixed_for_test_rows(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    stages, cols = ml.one_hot_stages(["c"])
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    model = Pipeline(stages=stages + [VectorAssembler(inputCols=cols + ["x"], outputCol="f")]).fit(train)
    test = spark.createDataFrame([("z", 1.0)], "c string, x double")
    assert model.transform(test).first().f.size == model.transform(train).first().f.size
    voc = ml.vocabulary(model, spark).orderBy("index").collect()
    assert [r.value for r in voc] == ["a", "b"]


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0), (3, 5.0, 5.0)], "i int, c double, x double")
    out = ml.minmax_scale(df, ["c", "x"], F.col("i") <= 2).orderBy("i").collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0] and [r.x for r in out] == [0.0, 1.0, 2.0]


def test_gbt_split_importance_counts(spark):
    rows = [([float(i % 10), float(i % 3), 1.0], float(i % 10) * 2.0, False) for i in range(200)]
    df = spark.createDataFrame(rows, "features array<double>, label double, is_val boolean")
    model = ml.fit_gbt(df, Boosting(rounds=3, depth=2, row_sample=1.0, column_sample=1.0))
    imp = {r.feature: r.importance for r in ml.split_count_importance(model, ["a", "b", "c"], spark).collect()}
    assert imp["a"] > 0 and imp["c"] == 0 and set(imp) == {"a", "b", "c"}
    assert sum(imp.values()) == sum(int(t.split.sum()) for t in model.trees)


def test_parameter_search_over_folds(spark):
    rng = np.random.default_rng(3)
    start = dt.date(2001, 1, 1)
    rows = [(start + dt.timedelta(days=d), s, "A", [float(d % 7), float(s)], float((d % 7) * s + rng.random())) for d in range(120) for s in (1, 2, 3)]
    m = spark.createDataFrame(rows, "date date, store_nbr int, family string, features array<double>, label double")
    grid = [Boosting(rounds=25, depth=1, rate=0.2), Boosting(rounds=25, depth=4, rate=0.2), Boosting(rounds=25, depth=4, rate=0.2)]
    out = ml.param_search(m, grid, n_splits=3).orderBy("position").collect()
    assert [r.best for r in out] == [False, True, False] or out[1].mean_rmsle != out[2].mean_rmsle
    assert out[1].mean_rmsle < out[0].mean_rmsle and {r.folds for r in out} == {3} and sum(r.best for r in out) == 1


def test_lag_model_scores_every_test_row(spark):
    from shelfcast.operators import ml

    start = dt.date(2001, 1, 1)
    rows = []
    for store in (1, 2):
        for i in range(216):
            d = start + dt.timedelta(days=i)
            split = "train" if i < 200 else "test"
            sales = float(10 * store + (20 if d.weekday() == 5 else 0)) if split == "train" else None
            rows.append((store * 1000 + i, d, split, store, "A", sales))
    feats = spark.createDataFrame(rows, "id long, date date, dataset_split string, store_nbr int, family string,"
                                        " sales double")
    model, _ = ml.fit_lag_model(feats, "2001-06-01", 16, Boosting(rounds=60, depth=4, rate=0.2))
    pred = ml.score_lag_model(model, feats, 16).toPandas()
    assert len(pred) == 32 and pred["predicted_sales"].notna().all()
    pred["truth"] = [10 * s + (20 if d.weekday() == 5 else 0) for s, d in zip(pred["store_nbr"], pred["date"])]
    assert (pred["predicted_sales"] - pred["truth"]).abs().max() < 2.0


def test_parameter_search_fits_every_round(monkeypatch):
    """The registered search hands over full fits, the original's depth among them."""
    from shelfcast.plans import registry

    monkeypatch.setattr(registry, "_matrix", lambda spark, d: ("matrix", None, None))
    monkeypatch.setattr(ml, "param_search", lambda matrix, grid, n_splits: (grid, n_splits))
    grid, folds = registry.q_t7(None, "")
    assert folds == 5 and all(params.rounds == 300 for params in grid)
    assert 8 in {params.depth for params in grid}


def test_boosted_queries_fit_the_original_rounds():
    from shelfcast.plans import registry

    assert registry.GBT == Boosting(rounds=300, depth=8, rate=0.05, row_sample=0.8, column_sample=0.8, l1=0.1, l2=1.0)


def test_train_and_compare_reads_back_what_it_wrote(spark, tmp_path):
    import pytest

    from shelfcast.plans.compare import train_and_compare

    df = _series(spark, [4.0, 4.0, 4.0]).unionByName(_series(spark, [2.0, 2.0, 2.0], store=2))
    def model(shift):
        return lambda: df.select("store_nbr", "family", "date", (F.col("sales") + shift).alias("yhat"), F.lit("m").alias("order_label"))
    store = str(tmp_path / "metrics")
    train_and_compare(spark, {"A": model(9.0), "Old": model(0.0)}, df, store)  # an earlier run of A, and another's
    long, best = train_and_compare(spark, {"A": model(3.0), "B": model(1.0), "C": model(-1.0)}, df, store)
    got = {(r.model, r.metric): r.value for r in long.collect()}
    assert len(got) == 9 and got["A", "mae"] == 3.0 and got["B", "rmse"] == got["C", "mae"] == 1.0
    assert best.first().best_model == "B"
    with pytest.raises(ValueError):
        train_and_compare(spark, {"A": model(3.0)}, df, store)
