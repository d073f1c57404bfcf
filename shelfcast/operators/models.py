"""Per-series statistical models (T13, T14). Both return forecast rows for the
horizon, so metrics are Spark aggregates afterwards.

T13 is a seasonal autoregression fitted by least squares on the (seasonally)
differenced series, orders chosen by AIC on a common sample, a re-aim of a
state-space seasonal ARIMA. Spark sums the lag cross-products of all series in
one aggregate; the small systems of the orders are solved from them in batches.

T14 is an additive trend + weekly/yearly Fourier seasonality + holiday +
regressor model fitted by ridge regression (``applyInPandas``, one series a
group, bounded by the calendar), a re-aim of a Bayesian additive model; its
bands hold the noise, the coefficients' variance and trend breaks to come."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checked_broadcast
from .series import SERIES

FORECAST_SCHEMA = ("store_nbr int, family string, date date, yhat double, yhat_lower double, "
                   "yhat_upper double, order_label string, aic double")


# ------------------------------------------------------------------ T13

# (p, d, P, D): lags 1..p and s, 2s..Ps of the series differenced d times by 1
# and D times by s.
ORDER_GRID = list(itertools.product([0, 1, 2], [0, 1], [0, 1], [0, 1]))


def _lags(p: int, P: int, s: int) -> list[int]:
    return list(range(1, p + 1)) + [s * k for k in range(1, P + 1)]


def _difference_polynomial(d: int, D: int, s: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^s)^D by power of the back shift B."""
    out = np.array([1.0])
    for step in [1] * d + [s] * D:
        out = np.convolve(out, np.concatenate([[1.0], np.zeros(step - 1), [-1.0]]))
    return out


class _Layout:
    """Where a grid's products lie: one triangle of cross-products of
    (1, z at each lag, z) for every (d, D), shared by all its (p, P)."""

    def __init__(self, grid: list[tuple[int, int, int, int]], s: int):
        self.grid, self.s = grid, s
        self.loss = max(d + D * s + max([0, *_lags(p, P, s)]) for p, d, P, D in grid)
        self.pairs = sorted({(d, D) for _, d, _, D in grid})
        self.lags = sorted({lag for p, _, P, _ in grid for lag in _lags(p, P, s)})
        self.width = len(self.lags) + 2
        self.triangle = [(i, j) for i in range(self.width) for j in range(i + 1)]

    def product_sums(self, y: list[Column], use: Column) -> Column:
        """Array of arrays: the triangle of each (d, D), summed over the rows
        in ``use``; ``y[k]`` is the value k rows before."""
        out = []
        for d, D in self.pairs:
            poly = _difference_polynomial(d, D, self.s)
            z = {k: sum((F.lit(float(c)) * y[k + j] for j, c in enumerate(poly) if c), F.lit(0.0)) for k in [0, *self.lags]}
            x = [F.lit(1.0), *[z[k] for k in self.lags], z[0]]
            out.append(F.array(*[F.sum(F.when(use, x[i] * x[j])) for i, j in self.triangle]))
        return F.array(*out)

    def solve(self, sums: np.ndarray, floor: np.ndarray, position: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least squares of one order for many series at once: (coefficients,
        residual sum of squares, AIC; NaN where rows are too few)."""
        p, d, P, D = self.grid[position]
        full = np.zeros((len(sums), self.width, self.width))
        for value, (i, j) in zip(sums.T, self.triangle):
            full[:, i, j] = full[:, j, i] = value
        cols = [0] + [1 + self.lags.index(lag) for lag in _lags(p, P, self.s)]
        gram, cross, square = full[:, cols][:, :, cols], full[:, cols, -1], full[:, -1, -1]
        n = gram[:, 0, 0]
        # Columns of very different size share one tolerance once they are scaled.
        scale = np.sqrt(np.diagonal(gram, axis1=1, axis2=2))
        scale = np.where(scale > 0, scale, 1.0)
        inverse = np.linalg.pinv(gram / (scale[:, :, None] * scale[:, None, :]), rcond=1e-10, hermitian=True)
        coef = np.einsum("rij,rj->ri", inverse, cross / scale) / scale
        rss = square - 2 * np.einsum("ri,ri->r", coef, cross) + np.einsum("ri,rij,rj->r", coef, gram, coef)
        rss = np.maximum(rss, floor)
        with np.errstate(divide="ignore", invalid="ignore"):
            aic = np.where(n > len(cols) + 1, n * np.log(rss / n) + 2 * len(cols), np.nan)
        return coef, rss, aic


def lag_moments(frame: DataFrame, val_start: str, test_start: str, s: int = 7,
                grid: list[tuple[int, int, int, int]] | None = None) -> DataFrame:
    """One row per series with history before ``val_start``: the lag
    cross-products of every differencing in the grid (``sums``) over a common
    sample, the rows that have every lag the grid needs; besides the mean that
    was taken off, the last values (``tail``, the newest last) and the dates to forecast.

    One window and one aggregate by series, so a frame bucketed by series is
    not exchanged. History rows without a value are left out first."""
    layout = _Layout(grid or ORDER_GRID, s)
    back = max(layout.loss, s)
    d, vs, ts = F.col("date"), F.lit(val_start).cast("date"), F.lit(test_start).cast("date")
    order = Window.partitionBy(*SERIES).orderBy("date")
    hist = d < vs
    value = F.col("sales").cast("double")
    known = value.isNotNull() & ~F.isnan(value)
    rows = frame.where((d < ts) & (~hist | known)).select(*SERIES, "date", hist.alias("_hist"), F.when(hist, value).alias("_v"))
    rows = rows.withColumn("_mean", F.avg("_v").over(Window.partitionBy(*SERIES)))
    rows = rows.withColumn("_y0", F.col("_v") - F.col("_mean"))
    rows = rows.select("*", *[F.lag("_y0", k).over(order).alias(f"_y{k}") for k in range(1, back + 1)])
    y = [F.col(f"_y{k}") for k in range(back + 1)]
    use = F.col("_hist")
    for k in range(layout.loss + 1):
        use = use & y[k].isNotNull()
    return rows.groupBy(*SERIES).agg(
        F.first("_mean").alias("mean"),
        F.count("_v").alias("n_hist"),
        (F.max("_v") - F.min("_v")).alias("spread"),
        F.sum(F.when(use, y[0] * y[0])).alias("squares"),
        layout.product_sums(y, use).alias("sums"),
        # the last values and the horizon: both bounded by the calendar
        F.max_by(F.array(*reversed(y[:back])), F.when(F.col("_hist"), d)).alias("tail"),
        F.sort_array(F.collect_list(F.when(~F.col("_hist"), d))).alias("dates"),
    ).where(F.col("n_hist") > 0)


def order_fits(moments: DataFrame, s: int = 7, grid: list[tuple[int, int, int, int]] | None = None) -> DataFrame:
    """Every order of the grid solved from the lag moments: one row per
    (series, order) with ``coef`` (intercept first, of the series less its mean),
    ``n``, ``rss`` and ``aic`` = n ln(RSS/n) + 2k; aic is null for a series
    with too few rows. A residual below 1e-12 of the sum of squares counts as
    that much, so that exact fits are told apart by their size alone."""
    layout = _Layout(grid or ORDER_GRID, s)

    @F.pandas_udf("coef array<double>, rss double, aic double")
    def solve(position: pd.Series, sums: pd.Series, squares: pd.Series) -> pd.DataFrame:
        coefs, rss, aic = [None] * len(position), np.full(len(position), np.nan), np.full(len(position), np.nan)
        for pos in position.unique():
            at = np.flatnonzero(((position == pos) & squares.notna()).to_numpy())
            if not len(at):
                continue
            floor = np.maximum(squares.iloc[at].to_numpy() * 1e-12, 1e-12)
            solved, rss[at], aic[at] = layout.solve(np.stack(sums.iloc[at].to_list()).astype(float), floor, int(pos))
            for i, c in zip(at, solved.tolist()):
                coefs[i] = c
        return pd.DataFrame({"coef": pd.Series(coefs, dtype=object), "rss": rss, "aic": aic})

    orders = F.array(*[F.struct(F.lit(i).alias("position"), *[F.lit(v).alias(k) for k, v in zip(("p", "d", "P_s", "D_s"), o)],
                                F.lit(layout.pairs.index((o[1], o[3])) + 1).alias("at")) for i, o in enumerate(layout.grid)])
    rows = moments.select("*", F.inline(orders)).withColumn("own", F.element_at("sums", F.col("at"))).drop("sums", "at")
    fit = rows.withColumn("fit", solve("position", "own", "squares"))
    aic = F.when(~F.isnan("fit.aic"), F.col("fit.aic"))
    return fit.select(*[c for c in moments.columns if c != "sums"], "position", "p", "d", "P_s", "D_s",
                      F.col("own")[0].cast("long").alias("n"), F.col("fit.coef").alias("coef"), F.col("fit.rss").alias("rss"), aic.alias("aic"))


def best_orders(fits: DataFrame) -> DataFrame:
    """The order with the smallest AIC of each series, ties to the earlier one
    of the grid. Series without a fit keep a row, its aic null."""
    facts = [c for c in ("mean", "n_hist", "spread", "tail", "dates") if c in fits.columns]
    key = F.struct(F.coalesce("aic", F.lit(float("inf"))), F.col("position"))
    best = F.min_by(F.struct("position", "p", "d", "P_s", "D_s", "n", "coef", "rss", "aic"), key)
    return fits.groupBy(*SERIES).agg(*[F.first(c).alias(c) for c in facts], best.alias("b")).select(*SERIES, *facts, "b.*")


def recursion(coef: np.ndarray, order: tuple[int, int, int, int], s: int) -> tuple[np.ndarray, np.ndarray]:
    """(intercept, weights) per series of y[t] = intercept + sum weights[j] y[t-1-j]:
    the autoregression times the differencing as one polynomial."""
    p, d, P, D = order
    lags = _lags(p, P, s)
    ar = np.zeros((len(coef), max([0, *lags]) + 1))
    ar[:, 0] = 1.0
    ar[:, lags] = -coef[:, 1:]
    poly = _difference_polynomial(d, D, s)
    out = np.zeros((len(coef), ar.shape[1] + len(poly) - 1))
    for j, c in enumerate(poly):
        out[:, j:j + ar.shape[1]] += c * ar
    return coef[:, 0], -out[:, 1:]


def forecast_paths(tail: np.ndarray, coef: np.ndarray, order: tuple[int, int, int, int], sd: np.ndarray, horizon: int,
                   s: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts and their standard errors, series x step. The spread grows
    with the step: each innovation runs on through the same recursion."""
    start, weights = recursion(coef, order, s)
    m = weights.shape[1]
    path = np.concatenate([tail[:, tail.shape[1] - m:], np.zeros((len(tail), horizon))], axis=1)
    impulse = np.zeros((len(tail), m + horizon))
    for h in range(horizon):
        past = slice(h, h + m)
        path[:, m + h] = start + np.einsum("rj,rj->r", path[:, past][:, ::-1], weights)
        impulse[:, m + h] = (h == 0) + np.einsum("rj,rj->r", impulse[:, past][:, ::-1], weights)
    return path[:, m:], sd[:, None] * np.sqrt(np.cumsum(impulse[:, m:] ** 2, axis=1))


def sarima_forecasts(frame: DataFrame, val_start: str, test_start: str, s: int = 7,
                     grid: list[tuple[int, int, int, int]] | None = None) -> DataFrame:
    """Seasonal AR forecasts of the validation period for every series (T13):
    lag moments by one aggregate, every order solved from them, the best by AIC
    run forward. Constant (or all-zero) series and series too short for the grid
    fall back to seasonal naive, as the original's callers skip failed fits;
    series with fewer than ``s`` values give no rows."""
    grid = grid or ORDER_GRID
    moments = lag_moments(frame, val_start, test_start, s, grid)
    best = best_orders(order_fits(moments, s, grid)).where((F.col("n_hist") >= s) & (F.size("dates") > 0))

    @F.pandas_udf("array<struct<yhat: double, sd: double>>")
    def run(position: pd.Series, coef: pd.Series, sd: pd.Series, tail: pd.Series, steps: pd.Series) -> pd.Series:
        out = [None] * len(position)
        for pos in position.dropna().unique():
            at = np.flatnonzero((position == pos).to_numpy())
            fc, se = forecast_paths(np.stack(tail.iloc[at].to_list()).astype(float), np.stack(coef.iloc[at].to_list()).astype(float),
                                    grid[int(pos)], sd.iloc[at].to_numpy(), int(steps.iloc[at].max()), s)
            for i, f, e in zip(at, fc, se):
                out[i] = [{"yhat": a, "sd": b} for a, b in zip(f[:steps.iat[i]], e)]
        return pd.Series(out, dtype=object)

    fitted = F.col("aic").isNotNull() & (F.col("spread") > 0)
    season = F.transform(F.slice("tail", -s, s), lambda v: F.struct(v.alias("yhat"), F.lit(0.0).alias("sd")))
    naive = F.transform(F.sequence(F.lit(0), F.size("dates") - 1), lambda i: F.get(season, i % s))
    path = run(F.when(fitted, F.col("position")), "coef", F.sqrt(F.col("rss") / F.col("n")), "tail", F.size("dates"))
    label = F.format_string("ar(p=%d,d=%d)(P=%d,D=%d)[%d]", "p", "d", "P_s", "D_s", F.lit(s))
    rows = best.withColumn("path", path).select(
        *SERIES, "mean", F.inline(F.arrays_zip(F.col("dates").alias("date"), F.coalesce("path", naive).alias("step"))),
        F.when(fitted, label).otherwise("seasonal_naive").alias("order_label"), F.when(fitted, F.col("aic")).alias("aic"))
    yhat = F.greatest(F.col("step.yhat") + F.col("mean"), F.lit(0.0))
    return rows.select(*SERIES, "date", yhat.alias("yhat"), F.greatest(yhat - 1.96 * F.col("step.sd"), F.lit(0.0)).alias("yhat_lower"),
                       (yhat + 1.96 * F.col("step.sd")).alias("yhat_upper"), "order_label", "aic")


FORECAST_SCHEMA_COLS = [c.split()[0] for c in FORECAST_SCHEMA.split(", ")]


# ------------------------------------------------------------------ T14

def future_frame(rows: DataFrame, oil: DataFrame, value: str = "dcoilwtico") -> DataFrame:
    """Rows to fit or forecast with the oil price of their date beside them
    (J12, a left join: dates without a price keep a null). Repeated dates of
    ``oil`` are averaged first, so no row is multiplied. One row a calendar day
    is broadcast once its count is checked."""
    daily = oil.groupBy("date").agg(F.avg(F.col(value).try_cast("double")).alias(value))
    return rows.join(checked_broadcast(daily), "date", "left")


def holiday_days(holiday_frame: DataFrame) -> DataFrame:
    """Names of each day's holidays and their prior scales (1 where T15 gives
    none; the largest where the rows of one name differ): one row a day."""
    names = holiday_frame.where(F.col("holiday").isNotNull() & F.col("ds").isNotNull())
    scale = F.max(F.coalesce("scale", F.lit(1.0))).over(Window.partitionBy("holiday"))
    named = F.sort_array(F.collect_set(F.struct("holiday", "prior")))
    days = names.select("holiday", F.col("ds").alias("date"), scale.alias("prior")).groupBy("date").agg(named.alias("_n"))
    return days.select("date", F.col("_n.holiday").alias("holiday_names"), F.col("_n.prior").alias("holiday_priors"))


def _fourier(x: np.ndarray, period: float, order: int) -> list[np.ndarray]:
    return [f(2 * np.pi * k * x / period) for k in range(1, order + 1) for f in (np.sin, np.cos)]


def _named_columns(names: list, priors: list, n_hist: int) -> tuple[list[np.ndarray], list[float]]:
    """A 0/1 column for each holiday that the history has, and its prior."""
    at: dict[str, list[int]] = {}
    prior: dict[str, float] = {}
    for i, (day, scales) in enumerate(zip(names, priors)):
        for name, scale in zip(day if day is not None else (), scales if scales is not None else ()):
            at.setdefault(name, []).append(i)
            prior[name] = scale
    cols, scales = [], []
    for name in sorted(at):
        if at[name][0] < n_hist:
            col = np.zeros(len(names))
            col[at[name]] = 1.0
            cols.append(col)
            scales.append(prior[name])
    return cols, scales


def trend_break_variance(slopes: np.ndarray, ahead: np.ndarray, per_unit: float) -> np.ndarray:
    """Variance of the trend ``ahead`` of the history, if slopes go on changing
    ``per_unit`` times a unit of time by Laplace steps as large as the fitted
    ones: a step at u adds (ahead - u) * step, so the sum is
    per_unit * 2 * mean|step|^2 * ahead^3 / 3."""
    if len(slopes) == 0:
        return np.zeros(len(ahead))
    return per_unit * 2 * np.mean(np.abs(slopes)) ** 2 * np.maximum(ahead, 0.0) ** 3 / 3


def additive_forecasts(frame: DataFrame, val_start: str, test_start: str,
                       regressors: tuple[str, ...] = ("onpromotion", "oil_price", "transactions"),
                       holidays: tuple[str, ...] = (), holiday_frame: DataFrame | None = None,
                       n_changepoints: int = 25, weekly_order: int = 3, yearly_order: int = 10,
                       changepoint_scale: float = 0.05, seasonality_scale: float = 10.0,
                       holiday_scale: float = 10.0, z: float = 1.96) -> DataFrame:
    """Additive model per series (T14): trend with hinge changepoints over the
    first 80 % of the history, weekly and yearly Fourier seasonality, named
    holidays (``holiday_frame`` as T15 gives it, joined by date; a name's prior
    scale is ``holiday_scale`` times its own, so 0.5 for local ones), indicator
    columns (``holidays``) and regressors (absent -> 0, future gaps
    forward/back filled), fitted by ridge regression. A coefficient's penalty is
    the noise variance over its squared prior scale, so a longer history
    outweighs the prior; the variance is taken from the residuals of the fit before.

    Bands are z standard errors: noise, variance of the coefficients and
    breaks of the trend to come, so they widen with the horizon. History rows
    without sales are left out; series with fewer than 14 give no rows."""
    vs, ts = pd.Timestamp(val_start).date(), pd.Timestamp(test_start).date()
    cols = list(regressors) + list(holidays)
    present = [c for c in cols if c in frame.columns]
    sel = frame.select(*SERIES, "date", "sales",
                       *[F.col(c).cast("double").alias(c) for c in present],
                       *[F.lit(0.0).alias(c) for c in cols if c not in present])
    if holiday_frame is not None:
        sel = sel.join(checked_broadcast(holiday_days(holiday_frame)), "date", "left")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        pdf[list(regressors)] = pdf[list(regressors)].ffill().bfill().fillna(0.0)
        hist = pdf[(pdf["date"] < vs)].dropna(subset=["sales"])
        fut = pdf[(pdf["date"] >= vs) & (pdf["date"] < ts)]
        if len(fut) == 0 or len(hist) < 14:
            return pd.DataFrame(columns=FORECAST_SCHEMA_COLS)
        both, n = pd.concat([hist, fut]), len(hist)
        dates = pd.to_datetime(both["date"])
        t0, span = dates.iloc[0], max((dates.iloc[n - 1] - dates.iloc[0]).days, 1)
        t = ((dates - t0).dt.days / span).to_numpy(dtype=float)
        breaks = np.linspace(0, 0.8, n_changepoints + 2)[1:-1]
        extra = both[cols].to_numpy(dtype=float)
        mu, sd = (extra[:n].mean(0), extra[:n].std(0)) if cols else (0.0, 1.0)
        extra = (extra - mu) / np.where(sd > 0, sd, 1.0)
        named, scales = [], []
        if "holiday_names" in both:
            named, scales = _named_columns(both["holiday_names"].to_list(), both["holiday_priors"].to_list(), n)
        seasonal = (_fourier(dates.dt.dayofweek.to_numpy(float), 7, weekly_order)
                    + _fourier(dates.dt.dayofyear.to_numpy(float), 365.25, yearly_order))
        X = np.column_stack([np.ones_like(t), t, *[np.maximum(t - c, 0.0) for c in breaks], *seasonal, *named, extra])
        prior = np.concatenate([  # one over the squared scale; none for level and slope
            [0.0, 0.0], np.full(len(breaks), changepoint_scale ** -2), np.full(len(seasonal), seasonality_scale ** -2),
            [(holiday_scale * s) ** -2 for s in scales], np.full(len(cols), holiday_scale ** -2)])
        Xh, Xf = X[:n], X[n:]
        y = hist["sales"].to_numpy(dtype=float)
        scale = max(np.abs(y).max(), 1.0)
        gram, cross, variance = Xh.T @ Xh, Xh.T @ (y / scale), 0.01
        for _ in range(8):
            lhs = gram + np.diag(variance * prior)
            coef = np.linalg.solve(lhs, cross)
            variance = max(float(np.mean((y / scale - Xh @ coef) ** 2)), 1e-12)
        spread = variance * (1 + np.einsum("ij,ji->i", Xf, np.linalg.solve(lhs, Xf.T)))
        spread += trend_break_variance(coef[2: 2 + len(breaks)], t[n:] - t[n - 1], len(breaks) / 0.8)
        yhat, half = Xf @ coef * scale, z * np.sqrt(spread) * scale
        return pd.DataFrame({
            "store_nbr": pdf["store_nbr"].iloc[0], "family": pdf["family"].iloc[0], "date": fut["date"].values,
            "yhat": np.maximum(yhat, 0.0), "yhat_lower": np.maximum(yhat - half, 0.0),
            "yhat_upper": np.maximum(yhat + half, 0.0), "order_label": "additive", "aic": float("nan"),
        })

    return sel.groupBy(*SERIES).applyInPandas(fit, FORECAST_SCHEMA)


def forecast_metrics(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Per-series RMSLE / RMSE / MAE of forecasts joined to actuals on the key."""
    from ..functions.metrics import error_aggregates

    j = forecasts.join(actuals.select(*SERIES, "date", "sales"), SERIES + ["date"])
    return j.groupBy(*SERIES).agg(*error_aggregates("sales", "yhat", "rmsle_only"),
                                  F.first("order_label").alias("model"))
