"""Model matrices and Spark ML models.

Boosted trees are those of ``boosting`` (one pass a round over staged blocks of
binned rows); the sequence model is a linear regression on flattened per-series
windows (the data flow of the recurrent nets: scale, window, fit, clip, score)."""

from __future__ import annotations

import hashlib

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import clip_zero, error_aggregates
from ..session import ensure_checkpoint_dir, path_exists
from .boosting import VERSION, BoostedTrees, Boosting, fit, fit_many, make_blocks
from .series import SERIES, fold_assignment, lag_features, positional_split, rolling_features, sequence_windows

TARGET = "sales"
# Columns that are never model inputs.
FEATURE_EXCLUDE = {"id", "date", "dataset_split", "sales", "holiday_names", "store_family_key"}


# ------------------------------------------------------------ encodings

def one_hot_stages(categorical: list[str]) -> tuple[list, list[str]]:
    """StringIndexer (alphabetical vocabulary, unseen -> extra slot) and
    OneHotEncoder keeping every level (F12). Returns stages and output cols."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                        outputCols=[f"{c}__ohe" for c in categorical], dropLast=False, handleInvalid="keep")
    return idx + [ohe], [f"{c}__ohe" for c in categorical]


def vocabulary(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Fitted one-hot vocabulary as rows (column, value, index)."""
    rows = []
    for st in model.stages:
        if hasattr(st, "labelsArray") and hasattr(st, "getInputCol"):
            for i, v in enumerate(st.labelsArray[0]):
                rows.append((st.getInputCol(), v, i))
    return spark.createDataFrame(rows, "column string, value string, index int")


def minmax_scale(df: DataFrame, cols: list[str], fit_where=None) -> DataFrame:
    """Min-max scaling with bounds from the ``fit_where`` rows (train), applied
    to all rows; a constant column maps to 0 (F13). Bounds are one row."""
    fit = df if fit_where is None else df.where(fit_where)
    b = F.broadcast(fit.agg(*[F.min(c).alias(f"_lo_{c}") for c in cols],
                            *[F.max(c).alias(f"_hi_{c}") for c in cols]))
    out = df.crossJoin(b)
    for c in cols:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        out = out.withColumn(c, (F.col(c) - lo) / F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo))
    return out.drop(*[f"_lo_{c}" for c in cols], *[f"_hi_{c}" for c in cols])


# ------------------------------------------------------------ matrices

def model_rows(features: DataFrame, test_start: str) -> DataFrame:
    """Train split, known target, before the test period."""
    return features.where((F.col("dataset_split") == "train") & F.col(TARGET).isNotNull()
                          & (F.col("date") < F.lit(test_start).cast("date")))


def feature_columns(df: DataFrame, exclude: set[str] = FEATURE_EXCLUDE) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns by exclusion."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (cat if isinstance(f.dataType, T.StringType) else num).append(f.name)
    return num, cat


def tabular_pipeline(num: list[str], cat: list[str]) -> Pipeline:
    """One-hot + assembler for the feature table."""
    stages, ohe_cols = one_hot_stages(cat)
    asm = VectorAssembler(inputCols=num + ohe_cols, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=stages + [asm])


def prepare_tabular(features: DataFrame, val_start: str, test_start: str) -> tuple[DataFrame, PipelineModel, list[str]]:
    """Model matrix of the feature table (T8): numeric columns coerced to
    double with null -> 0, one-hot over the train+validation vocabulary, label
    = sales (null -> 0), ``is_val`` = date >= val_start. Raises when either
    side is empty."""
    rows = model_rows(features, test_start)
    num, cat = feature_columns(rows)
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in num})
    rows = rows.withColumns({
        "label": F.coalesce(F.col(TARGET).try_cast("double"), F.lit(0.0)),
        "is_val": F.col("date") >= F.lit(val_start).cast("date"),
    })
    model = tabular_pipeline(num, cat).fit(rows)
    matrix = model.transform(rows)
    counts = {r["is_val"]: r["count"] for r in matrix.groupBy("is_val").count().collect()}
    if not counts.get(False) or not counts.get(True):
        raise ValueError("train/validation split is empty; check date range")
    return matrix, model, expanded_names(model, num, cat)


def expanded_names(model: PipelineModel, num: list[str], cat: list[str]) -> list[str]:
    names = list(num)
    labels = {st.getInputCol(): st.labelsArray[0] for st in model.stages if hasattr(st, "labelsArray")}
    for c in cat:
        names += [f"{c}_{v}" for v in labels[c]] + [f"{c}__unseen"]
    return names


def lag_training_frame(df: DataFrame, include_current: bool = True) -> DataFrame:
    """Lag-feature frame (T9): calendar, lags 1/7/14/28, rolling mean/std over
    full windows (the original includes the current target; pass False for an
    honest frame), rows with any null dropped."""
    d = F.col("date")
    kept = [c for c in ("onpromotion",) if c in df.columns]
    out = df.select(*SERIES, "date", TARGET, *kept).withColumns({
        "dayofweek": F.weekday(d), "month": F.month(d), "quarter": F.quarter(d), "year": F.year(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
    })
    out = rolling_features(lag_features(out, TARGET), TARGET, include_current)
    return out.dropna()


# The columns that the lag trainer one-hot encodes.
LAG_CATEGORICAL = ("store_nbr", "family", "dayofweek", "month")


def lag_matrix(frame: DataFrame, train_share: float = 0.8) -> tuple[DataFrame, PipelineModel, list[str]]:
    """Model matrix of the lag frame: one-hot store, family, weekday and month
    beside the numeric columns; ``is_val`` marks the rows after the first
    ``train_share`` in date order (the positional split)."""
    num = [f.name for f in frame.schema.fields
           if f.name not in (*LAG_CATEGORICAL, "date", TARGET) and not isinstance(f.dataType, T.StringType)]
    rows = frame.withColumns({f"{c}_key": F.col(c).cast("string") for c in LAG_CATEGORICAL})
    rows = rows.withColumns({c: F.col(c).cast("double") for c in num}).withColumn("label", F.col(TARGET).cast("double"))
    model = tabular_pipeline(num, [f"{c}_key" for c in LAG_CATEGORICAL]).fit(rows)
    split = positional_split(model.transform(rows), ["date"], train_share)
    matrix = split.withColumn("is_val", F.col("split") == "val").drop("split")
    return matrix, model, expanded_names(model, num, [f"{c}_key" for c in LAG_CATEGORICAL])


# ------------------------------------------------ lag model for test scoring

def horizon_lag_frame(rows: DataFrame, horizon: int, lags=(1, 7, 14, 28)) -> DataFrame:
    """Calendar, lag and full-window rolling features that only look at rows
    at least ``horizon`` rows back (T9 shifted for scoring, fixes Q21): lag k
    becomes lag k + horizon - 1 and the rolling windows end ``horizon`` rows
    back, so every one of the next ``horizon`` unlabeled rows of a series has
    the same, fully known features as a training row. Rows keep a null target.
    One shuffle by series; the panel is dense, so row lags are day lags."""
    shift = horizon - 1
    w = Window.partitionBy(*SERIES).orderBy("date")
    d, y = F.col("date"), F.col(TARGET)
    cols = {"dayofweek": F.weekday(d), "month": F.month(d), "quarter": F.quarter(d), "year": F.year(d),
            "is_weekend": (F.weekday(d) >= 5).cast("int")}
    cols.update({f"{TARGET}_lag_{k + shift}": F.lag(y, k + shift).over(w) for k in lags})
    for n in (7, 14):
        wn = w.rowsBetween(-(shift + n), -(shift + 1))
        cols[f"rolling_mean_{n}"] = F.when(F.count(y).over(wn) == n, F.avg(y).over(wn))
    w7 = w.rowsBetween(-(shift + 7), -(shift + 1))
    cols["rolling_std_7"] = F.when(F.count(y).over(w7) == 7, F.stddev_samp(y).over(w7))
    return rows.withColumns(cols)


def horizon_feature_names(horizon: int, lags=(1, 7, 14, 28)) -> list[str]:
    return (["dayofweek", "month", "quarter", "year", "is_weekend"]
            + [f"{TARGET}_lag_{k + horizon - 1}" for k in lags]
            + ["rolling_mean_7", "rolling_mean_14", "rolling_std_7"])


def prepend_history(train_rows: DataFrame, test_rows: DataFrame) -> DataFrame:
    """Training rows prepended to the unlabeled rows (U3): columns aligned by
    name, the target null on test rows."""
    return train_rows.unionByName(test_rows, allowMissingColumns=True)


def scoring_frame(features: DataFrame, horizon: int) -> DataFrame:
    """Test rows with horizon-safe lag features computed over train + test
    (U3 -> T9). Only rows without a full history are dropped, never rows for
    their missing target (fixes Q21)."""
    train = features.where(F.col("dataset_split") == "train").select(*SERIES, "date", F.col(TARGET).cast("double"))
    test = features.where(F.col("dataset_split") == "test").select("id", *SERIES, "date")
    frame = horizon_lag_frame(prepend_history(train, test), horizon)
    return frame.where(F.col("id").isNotNull()).dropna(subset=horizon_feature_names(horizon))


def fit_lag_model(features: DataFrame, val_start: str, horizon: int, params: Boosting = Boosting()) -> tuple[BoostedTrees, DataFrame]:
    """Boosted trees on the horizon-safe lag frame of the training rows
    (T9, T10): rows from ``val_start`` on are held out for validation.
    Returns the fitted trees and the whole frame."""
    names = horizon_feature_names(horizon)
    rows = features.where(F.col("dataset_split") == "train").select(*SERIES, "date", F.col(TARGET).cast("double"))
    frame = (horizon_lag_frame(rows, horizon).dropna(subset=names + [TARGET])
             .withColumn("label", F.col(TARGET))
             .withColumn("is_val", F.col("date") >= F.lit(val_start).cast("date")))
    frame = frame.withColumn("features", feature_array(names))
    return fit(frame, params), frame


def feature_array(names: list[str]):
    """Columns as one array of doubles."""
    return F.array(*[F.col(n).cast("double") for n in names])


def score_lag_model(model: BoostedTrees, features: DataFrame, horizon: int) -> DataFrame:
    """Predictions for the unlabeled test rows (T16): date, store, family,
    predicted_sales clipped at zero (S10 layout) and the row id."""
    pred = model.transform(scoring_frame(features, horizon).withColumn("features", feature_array(horizon_feature_names(horizon))))
    return pred.select("id", "date", *SERIES, clip_zero(F.col("prediction")).alias("predicted_sales"))


# ------------------------------------------------------------ boosted trees

def fit_gbt(matrix: DataFrame, params: Boosting = Boosting()) -> BoostedTrees:
    """Squared-error boosted trees (T10) on the rows of the matrix before the
    validation period. Every round is kept: the original's watch set is only
    logged, so it must not stop the fit early."""
    return fit(matrix, params)


def watch_log(model: BoostedTrees, spark: SparkSession) -> DataFrame:
    """RMSE on the training and the validation rows after each round."""
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(model.watch, 1)]
    return spark.createDataFrame(rows, "round int, train_rmse double, validation_rmse double")


def saved_model(spark: SparkSession, key: tuple, make) -> BoostedTrees:
    """The model saved under ``key`` in the shared folder, made and saved if
    there is none: one fit serves every query over the same input."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{base.rstrip('/')}/models/{hashlib.sha256(repr((VERSION, key)).encode()).hexdigest()[:24]}"
    if not path_exists(spark, f"{path}/settings/_SUCCESS"):
        make().save(spark, path)
    return BoostedTrees.load(spark, path)


def evaluate_predictions(pred: DataFrame, group: str | None = None) -> DataFrame:
    """RMSLE / MAE / RMSE of clipped predictions (A14 with clip 'pred')."""
    p = pred.withColumn("prediction", clip_zero(F.col("prediction")))
    aggs = error_aggregates("label", "prediction", "pred")
    return p.groupBy(group).agg(*aggs) if group else p.agg(*aggs)


def split_metrics(model, matrix: DataFrame) -> DataFrame:
    """Train and validation metric rows (split, rmsle, mae, rmse, n_trees)."""
    pred = model.transform(matrix).withColumn("split", F.when(F.col("is_val"), "validation").otherwise("train"))
    return evaluate_predictions(pred, "split").select("split", "rmsle", "mae", "rmse", F.lit(model.n_trees).alias("n_trees"))


def split_count_importance(model: BoostedTrees, feature_names: list[str], spark: SparkSession) -> DataFrame:
    """Number of splits per feature across all trees (T11), every feature
    listed (missing -> 0, J11), ordered by importance (L4)."""
    used = [(int(f),) for t in model.trees for f in t.feature[t.split]]
    counts = (spark.createDataFrame(used, "feature_index int").groupBy("feature_index")
              .agg(F.count(F.lit(1)).alias("importance")))
    names = spark.createDataFrame(list(enumerate(feature_names)), "feature_index int, feature string")
    return (names.join(counts, "feature_index", "left")
            .select("feature", F.coalesce(F.col("importance"), F.lit(0)).cast("bigint").alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    """The n most important features (L4): a top-k report."""
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def score_test(features: DataFrame, model: PipelineModel, trees: BoostedTrees) -> DataFrame:
    """Predictions for the unlabeled test rows with the fitted matrix pipeline
    (fixed vocabulary) and trees (T16): date, store, family, predicted_sales."""
    rows = features.where(F.col("dataset_split") == "test")
    num, _ = feature_columns(rows)
    keys = rows.select(F.col("id").alias("_id"), *[F.col(c).alias(f"_k_{c}") for c in SERIES], "*")
    coerced = keys.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in num})
    matrix = model.transform(coerced).select("_id", *[f"_k_{c}" for c in SERIES], "date", "features")
    pred = trees.transform(matrix)
    return pred.select(F.col("_id").alias("id"), *[F.col(f"_k_{c}").alias(c) for c in SERIES], "date",
                       clip_zero(F.col("prediction")).alias("predicted_sales"))


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline of encoders (S13); trees have their own ``save``."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def param_search(matrix: DataFrame, grid: list[Boosting], n_splits: int = 5) -> DataFrame:
    """Expanding-window folds over the rows in date order (W11) x settings;
    mean RMSLE per setting; the first strictly smallest wins (T7). Returns one
    row per setting with ``best`` marking the winner.

    All fits, settings x folds, are made side by side: each round is one pass
    over the blocks for all of them."""
    spark = matrix.sparkSession
    folds = fold_assignment(matrix, n_splits, ["store_nbr", "family"], ["date"])
    coded = folds.select("features", "label", F.coalesce(F.col("test_fold") + 1, F.lit(0)).alias("_code"))
    blocks = make_blocks(coded, "features", "label", "_code")
    models = iter(fit_many(blocks, [(p, k) for p in grid for k in range(n_splits)]))
    results = []
    for pos, p in enumerate(grid):
        scores = [next(models).test_rmsle for _ in range(n_splits)]
        results.append((pos, p.depth, p.rounds, p.rate, n_splits, sum(scores) / n_splits))
    df = spark.createDataFrame(results, "position int, depth int, rounds int, rate double, folds int, mean_rmsle double")
    best = df.agg(F.min_by("position", F.struct("mean_rmsle", "position")).alias("_b"))
    return df.crossJoin(F.broadcast(best)).withColumn("best", F.col("position") == F.col("_b")).drop("_b")


# ------------------------------------------------------------ sequence model

def sequence_dataset(frame: DataFrame, feature_cols: list[str], val_start: str, length: int = 14) -> DataFrame:
    """Scaled per-series windows (F13 fitted on train rows, W12) flattened to a
    vector column; ``is_val`` marks windows whose target is in validation."""
    vs = F.lit(val_start).cast("date")
    scaled = minmax_scale(frame.withColumn("_target", F.col(TARGET)), feature_cols, F.col("date") < vs)
    win = sequence_windows(scaled, feature_cols, "_target", length)
    return win.select(*SERIES, "date",
                      array_to_vector(F.flatten("window")).alias("features"),
                      F.col("target").cast("double").alias("label"),
                      (F.col("date") >= vs).alias("is_val"))


def sequence_regression(dataset: DataFrame, reg: float = 0.0):
    """Linear regression on flattened windows, trained on the train windows."""
    lr = LinearRegression(featuresCol="features", labelCol="label", regParam=reg)
    return lr.fit(dataset.where(~F.col("is_val")))
