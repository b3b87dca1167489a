import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from hearthwatt.operators import best_model, best_model_name, metric_suite, metric_table


@pytest.fixture()
def predictions(spark):
    rows = [(float(1 + i % 7), float(1 + (i * 3) % 8) + 0.25, float(1 + i % 7) + 0.5) for i in range(50)]
    return spark.createDataFrame(rows, "label double, first double, second double")


@pytest.mark.parametrize("metric", ["rmse", "mae", "r2"])
def test_metrics_agree_with_mllib(predictions, metric):
    table = {r["model"]: r for r in metric_table(predictions, {"a": "first", "b": "second"}).collect()}
    for model, column in {"a": "first", "b": "second"}.items():
        evaluator = RegressionEvaluator(labelCol="label", predictionCol=column, metricName=metric)
        assert table[model][metric] == pytest.approx(evaluator.evaluate(predictions), rel=1e-12)
        suite = metric_suite(predictions, "label", column).first()
        assert suite[metric] == pytest.approx(table[model][metric], rel=1e-12)
        assert suite["r2_pct"] == pytest.approx(100 * suite["r2"])


def test_mape_of_zero_labels(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "label double, prediction double")
    guarded = metric_suite(df).first()
    skipped = metric_suite(df, skip_zero=True).first()
    assert guarded["mape"] == pytest.approx((1 / 1e-9 + 0.1) / 2 * 100)
    assert skipped["mape"] == pytest.approx(10.0)
    assert guarded["zero_labels"] == skipped["zero_labels"] == 1


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label double, prediction double")
    row = metric_suite(df).first()
    assert row["r2"] is None and row["rmse"] == 1.0


def test_rows_without_prediction_do_not_count(spark):
    df = spark.createDataFrame([(2.0, 1.0), (5.0, None), (None, 3.0)], "label double, prediction double")
    row = metric_suite(df).first()
    assert (row["rows"], row["rmse"]) == (1, 1.0)


def test_best_model(spark):
    table = spark.createDataFrame(
        [("b", 1.0, 0.5), ("a", 1.0, 0.4), ("c", None, None)], "model string, rmse double, r2 double"
    )
    assert best_model(table, "rmse").first()["model"] == "a"
    assert best_model(table, "r2", largest=True).first()["model"] == "b"
    assert best_model_name(table) == "a"
    with pytest.raises(ValueError):
        best_model_name(table.limit(0))
