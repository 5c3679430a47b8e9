import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from kerbside import operators as ops
from kerbside.functions import clean
from kerbside.operators.fare_model import canonical_rows
from kerbside.sources import trips_table


@pytest.fixture(scope="module")
def dataset(spark):
    trips = clean(trips_table(spark, "/root/testdata/sf0.01"), "model")
    return ops.ml_dataset(trips).cache()


@pytest.fixture(scope="module")
def parts(dataset):
    return ops.split(dataset)


@pytest.fixture(scope="module")
def scored(parts):
    train, test = parts
    return ops.fare_predictions(ops.fit_fare_model(train), test).cache()


def test_split_is_a_complement_whatever_the_partitions(dataset, parts):
    train, test = parts
    assert train.unionAll(test).exceptAll(dataset).isEmpty()
    assert train.count() + test.count() == dataset.count()
    assert test.count() / dataset.count() == pytest.approx(0.2, abs=0.01)
    _, again = ops.split(dataset.repartition(3, "hour"))
    assert again.count() == test.count() and again.exceptAll(test).isEmpty()
    _, other = ops.split(dataset, seed=1)
    assert not other.exceptAll(test).isEmpty()


def test_split_counts(dataset, parts):
    counts = {r["part"]: r["n"] for r in ops.split_counts(dataset).collect()}
    assert counts == {"train": parts[0].count(), "test": parts[1].count()}


def test_split_share(dataset):
    _, half = ops.split(dataset, test_share=0.5)
    assert half.count() / dataset.count() == pytest.approx(0.5, abs=0.01)


def test_day_index_follows_frequency(dataset):
    ranked = ops.day_index(dataset).orderBy("day_index").collect()
    assert [r["day_index"] for r in ranked] == [float(i) for i in range(7)]
    assert [r["n"] for r in ranked] == sorted((r["n"] for r in ranked), reverse=True)


def test_metrics_agree_with_the_evaluator(parts, scored):
    figures = ops.fare_model_metrics(scored, parts[0]).first()
    for name in ("rmse", "r2"):
        judge = RegressionEvaluator(
            labelCol="total_amount", predictionCol="prediction", metricName=name
        )
        assert figures[name] == pytest.approx(judge.evaluate(scored), rel=1e-9)
    assert figures["train_rows"] == parts[0].count()
    assert figures["test_rows"] == parts[1].count()
    assert 3.0 < figures["rmse"] < 4.6
    assert 0.7 < figures["r2"] < 0.9


def test_forest_settings(parts):
    model = ops.fit_fare_model(parts[0], trees=3)
    forest = model.stages[-1]
    assert forest.getNumTrees == 3
    assert forest.getOrDefault("maxDepth") == 5 and forest.getOrDefault("maxBins") == 32
    assert forest.numFeatures == 5


def test_same_model_on_a_rerun(parts, scored):
    train, test = parts
    again = ops.fare_predictions(ops.fit_fare_model(train), test)
    total = F.sum("prediction")
    assert again.agg(total).first()[0] == pytest.approx(scored.agg(total).first()[0], rel=1e-12)


def test_sample_is_repeatable(parts):
    train, test = parts
    model = ops.fit_fare_model(train, trees=2)
    first = ops.fare_prediction_sample(model, test).collect()
    assert len(first) == 10
    assert first == ops.fare_prediction_sample(model, test.repartition(5)).collect()


def test_the_layout_of_files_changes_no_prediction(parts):
    train, test = parts
    seen = []
    for partitions in (3, 8, 64):
        model = ops.fit_fare_model(train.repartition(partitions, "trip_distance", "hour"))
        scored = ops.fare_predictions(model, test).orderBy(*test.columns).select("prediction")
        seen.append([row[0] for row in scored.collect()])
    assert seen[0] == pytest.approx(seen[1], rel=1e-9) and seen[0] == pytest.approx(seen[2], rel=1e-9)


def test_canonical_rows_are_the_same_rows_spread_evenly(spark, parts):
    """A row that makes up half of all lies in many partitions, and every copy is there."""
    train = parts[0].limit(2000)
    hot = train.limit(1).crossJoin(spark.range(2000)).drop("id")
    every = train.unionAll(hot)
    rows = canonical_rows(every, 8, chunk=50)
    assert rows.exceptAll(every).isEmpty() and every.exceptAll(rows).isEmpty()
    sizes = sorted(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[0]


def test_checks_hold_and_can_fail(parts, scored):
    train, _ = parts
    checks = ops.fare_model_checks(scored, train).first().asDict()
    assert all(value is True for name, value in checks.items() if not name.endswith("_rows"))
    far = scored.withColumn("prediction", F.lit(1e9))
    assert not ops.fare_model_checks(far, train).first()["within_labels"]
