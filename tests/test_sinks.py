"""Sinks and optional sources (S5-S11, S13, S14) round-trip through files."""

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer

from shelfcast.operators import ml, quality
from shelfcast.sources import readers, sinks


def test_table_csv_and_parquet_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, name string, v double")
    sinks.write_table(df, str(tmp_path / "t_csv"), fmt="csv")
    back = spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "t_csv"))
    assert sorted(back.collect()) == sorted(df.collect())
    sinks.write_table(df, str(tmp_path / "t_pq"), partition_by=["name"])
    assert spark.read.parquet(str(tmp_path / "t_pq")).count() == 2


def test_json_rows(spark, tmp_path):
    df = spark.createDataFrame([("rmsle", 0.25)], "metric string, value double")
    sinks.write_json_rows(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).collect()[0]["value"] == 0.25


def test_optional_source_absent_is_none(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "missing")) is None
    spark.range(3).write.parquet(str(tmp_path / "present"))
    assert readers.read_optional(spark, str(tmp_path / "present")).count() == 3


def test_experiment_log_appends(spark, tmp_path):
    path = str(tmp_path / "experiments")
    sinks.log_experiment(spark, path, "baseline", "seasonal_naive", {"period": 7}, {"rmsle": 0.3}, 1.234)
    sinks.log_experiment(spark, path, "baseline", "seasonal_naive", {"period": 14}, {"rmsle": 0.4}, 2.0,
                         extra={"series": "1_A"})
    rows = spark.read.parquet(path).orderBy("runtime_seconds").collect()
    assert [r["params"]["period"] for r in rows] == ["7", "14"]
    assert rows[0]["runtime_seconds"] == 1.23 and rows[1]["extra"] == {"series": "1_A"}


def test_prediction_and_metric_sinks(spark, tmp_path):
    pred = spark.createDataFrame([(3, 1.5), (1, 0.0), (2, 7.25)], "id int, sales double")
    sinks.write_predictions(pred, str(tmp_path / "sub"))
    back = spark.read.option("header", True).csv(str(tmp_path / "sub")).collect()
    assert [int(r["id"]) for r in back] == [1, 2, 3]
    metrics = spark.createDataFrame([(1, "A", 0.1)], "store_nbr int, family string, rmsle double")
    path = str(tmp_path / "metrics")
    sinks.append_metrics(metrics, path, "baseline")
    sinks.append_metrics(metrics, path, "gbt")
    table = spark.read.parquet(path)
    assert table.count() == 2
    assert readers.metrics_for_model(table, "gbt").count() == 1


def test_model_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "family string")
    model = Pipeline(stages=[StringIndexer(inputCol="family", outputCol="ix", stringOrderType="alphabetAsc")]).fit(df)
    path = ml.save_model(model, str(tmp_path / "m"))
    loaded = ml.load_pipeline(path)
    assert [r["ix"] for r in loaded.transform(df).collect()] == [1.0, 0.0, 1.0]


def test_lineage_rows(spark):
    rows = quality.lineage(spark, {"train": "/in/train"}, {"feature_dataset": "/out/f"}).collect()
    kinds = [r["kind"] for r in rows]
    assert kinds.count("transformation") == len(quality.lineage_steps())
    assert {r["path"] for r in rows if r["kind"] == "source" and r["name"] == "train"} == {"/in/train"}
    steps = [r["step"] for r in rows if r["kind"] == "transformation"]
    assert steps == list(range(1, len(steps) + 1))


def test_feature_scan_prunes_and_filters(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2001, 1, 1), "train", 1.0, 5), (dt.date(2001, 1, 2), "test", None, 6)],
                               "date date, dataset_split string, sales double, x int")
    df.write.parquet(str(tmp_path / "f"))
    scan = readers.read_feature_table(spark, str(tmp_path / "f"), ["date", "sales"], split="train")
    assert scan.columns == ["date", "sales"] and scan.count() == 1
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dataset_split), EqualTo(dataset_split,train)]" in plan
