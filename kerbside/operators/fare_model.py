"""The fare model: a random forest on zone, distance, hour and weekday."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.derive import with_calendar
from kerbside.operators.core import count_by
from kerbside.sources.shared import stored

LABEL = "total_amount"
MODEL_COLUMNS = (
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "hour",
    "day_of_week",
    "total_amount",
)
FEATURES = ("PULocationID", "DOLocationID", "trip_distance", "hour", "day_index")


def ml_dataset(trips: DataFrame) -> DataFrame:
    """The model's columns of model-clean trips, rows with a null dropped."""
    return with_calendar(trips).select(*MODEL_COLUMNS).na.drop()


def _as_text(df: DataFrame, name: str) -> Column:
    """A value as text that any engine writes alike: fractions as whole millionths."""
    if dict(df.dtypes)[name] in ("double", "float"):
        return F.round(F.col(name) * 1_000_000).cast("bigint").cast("string")
    return F.col(name).cast("string")


def is_test_row(df: DataFrame, test_share: float = 0.2, seed: int = 1234) -> Column:
    """Whether a row belongs to the test part, told by a hash of the whole row."""
    text = F.concat_ws("|", F.lit(str(seed)), *[_as_text(df, name) for name in df.columns])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    return bucket < round(test_share * 10_000)


def split(df: DataFrame, test_share: float = 0.2, seed: int = 1234) -> tuple[DataFrame, DataFrame]:
    """Train and test rows.

    The parts are exact complements however the rows are spread or recomputed after an
    executor is lost. Equal rows fall on the same side, so no test row was trained on.
    """
    is_test = is_test_row(df, test_share, seed)
    return df.filter(~is_test), df.filter(is_test)


def split_counts(df: DataFrame, test_share: float = 0.2, seed: int = 1234) -> DataFrame:
    """``part`` and its rows ``n``, from one pass."""
    part = F.when(is_test_row(df, test_share, seed), "test").otherwise("train")
    return count_by(df.select(part.alias("part")), ["part"])


def day_indexer(counts: DataFrame) -> StringIndexerModel:
    """The indexer of ``day_of_week``, from its counts: one row per day reaches the driver."""
    days = counts.orderBy(F.desc("n"), "day_of_week").collect()
    return StringIndexerModel.from_labels(
        [row["day_of_week"] for row in days], inputCol="day_of_week", outputCol="day_index"
    )


def day_index(df: DataFrame) -> DataFrame:
    """``day_of_week``, ``n`` and ``day_index``: 0 for the most frequent, ties by name."""
    counts = stored(count_by(df.select("day_of_week"), ["day_of_week"], derive=False), "day-counts")
    return day_indexer(counts).transform(counts)


def canonical_rows(df: DataFrame, partitions: int, chunk: int = 65_536) -> DataFrame:
    """The same rows in an order and in partitions that depend on nothing but the rows.

    Equal rows are counted first, combined before the shuffle, and come in chunks of ``chunk``. Chunks go
    to a partition by the hash of row and chunk number and are sorted there, so a row that makes up
    a third of all is spread, too. The counts are stored.
    """
    columns = df.columns
    counted = stored(df.groupBy(*columns).agg(F.count("*").alias("copies")), "counted-rows")
    last = F.ceil(F.col("copies") / chunk) - 1
    chunks = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    placed = chunks.repartition(partitions, *columns, "chunk").sortWithinPartitions(*columns, "chunk")
    held = F.least(F.lit(chunk).cast("bigint"), F.col("copies") - F.col("chunk") * chunk)
    return placed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), held))).select(*columns)


def fit_fare_model(
    train: DataFrame, trees: int = 20, seed: int = 1234, partitions: int = 32
) -> PipelineModel:
    """Fit indexer, assembler and forest. Runs at once.

    The forest draws its samples by partition and place, so it is fitted on ``canonical_rows``: the
    model follows from the rows and the number of ``partitions``, not from how files hold them. Take
    some million rows a partition. The fit passes over the rows some three times before the forest
    keeps its own binned copy; their one shuffle serves all passes.
    """
    forest = RandomForestRegressor(
        labelCol=LABEL, featuresCol="features", numTrees=trees, seed=seed
    )
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    days = count_by(train.select("day_of_week"), ["day_of_week"], derive=False)
    rows = canonical_rows(train.select(*MODEL_COLUMNS), partitions)
    return Pipeline(stages=[day_indexer(days), assembler, forest]).fit(rows)


def fare_predictions(model: PipelineModel, test: DataFrame) -> DataFrame:
    """The test rows with ``prediction``."""
    return model.transform(test).select(*test.columns, "prediction")


def fare_model_metrics(predictions: DataFrame, train: DataFrame) -> DataFrame:
    """Row counts of both parts, root mean squared error and R² on the test part."""
    empty = F.lit(None).cast("double")
    scored = predictions.select(
        F.col(LABEL).alias("actual"), "prediction", F.lit(1).alias("is_test")
    )
    trained = train.select(
        empty.alias("actual"), empty.alias("prediction"), F.lit(0).alias("is_test")
    )
    error = F.avg(F.pow(F.col("actual") - F.col("prediction"), 2))
    return scored.unionAll(trained).agg(
        F.count_if(F.col("is_test") == 0).alias("train_rows"),
        F.count_if(F.col("is_test") == 1).alias("test_rows"),
        F.sqrt(error).alias("rmse"),
        (1 - F.try_divide(error, F.var_pop("actual"))).alias("r2"),
    )


def fare_sample_rows(rows: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` rows in the order of all model columns: the same ones every time."""
    return rows.orderBy("trip_distance", LABEL, *MODEL_COLUMNS[:2], "hour", "day_of_week").limit(k)


def fare_prediction_sample(model: PipelineModel, test: DataFrame, k: int = 10) -> DataFrame:
    """``k`` test trips with their actual and predicted total. Only these are scored."""
    return fare_predictions(model, fare_sample_rows(test, k)).select(
        "trip_distance", LABEL, "prediction"
    )


def fare_model_checks(predictions: DataFrame, train: DataFrame) -> DataFrame:
    """What holds of any good fit: row counts of both parts, and whether every prediction lies
    within the train labels, none is null, the error is below the labels' spread, R² above 0."""
    figures = fare_model_metrics(predictions, train)
    low_high = train.agg(F.min(LABEL).alias("low"), F.max(LABEL).alias("high"))
    shown = predictions.agg(
        F.min("prediction").alias("least"),
        F.max("prediction").alias("most"),
        F.count_if(F.col("prediction").isNull()).alias("missing"),
        F.stddev_pop(LABEL).alias("spread"),
    )
    # Three frames of one row each, side by side.
    row = [frame.withColumn("one", F.lit(1)) for frame in (figures, low_high, shown)]
    joined = row[0].join(row[1], "one").join(row[2], "one")
    return joined.select(
        "train_rows",
        "test_rows",
        ((F.col("least") >= F.col("low")) & (F.col("most") <= F.col("high"))).alias("within_labels"),
        (F.col("missing") == 0).alias("all_predicted"),
        (F.col("rmse") < F.col("spread")).alias("better_than_mean"),
        (F.col("r2") > 0).alias("explains_some"),
    )
