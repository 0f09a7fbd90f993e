"""Sales and price models, product segments, forecasts and price irregularities (Spark ML)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pasarlens.functions import exact_avg, in_window, is_weekend, segment_name
from pasarlens.operators.selection import exact_median
from pasarlens.plans.features import seq_split_rows
from pasarlens.sources.tables import stored

# The columns the models learn from.
SALES_NUMBERS = [
    "avg_price",
    "avg_discount",
    "avg_rating",
    "review_count",
    "day_of_week",
    "month",
    "is_weekend",
    "sales_lag_1",
    "sales_lag_7",
    "sales_ma_7",
]
SALES_CATEGORIES = ["price_category", "category"]
PRICE_NUMBERS = ["sales_count", "rating", "review_count", "discount_percent"]
PRICE_CATEGORIES = ["category"]
#: Shuffle partitions that a cached plan may keep.
FEW_PARTITIONS = 32
CLUSTER_COLUMNS = ["avg_price", "avg_sales", "avg_rating", "avg_discount", "frequency"]


def _doubles(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _inputs(numbers: list[str], categories: list[str], one_hot: bool) -> list:
    """Stages from raw columns to one ``features`` vector.

    Missing numbers take the training mean and unseen categories an index of their own. Trees split on category
    indexes directly; the linear model gets one column per category.
    """
    filled = [f"{n}_filled" for n in numbers]
    indexed = [f"{c}_index" for c in categories]
    stages = [
        Imputer(strategy="mean", inputCols=numbers, outputCols=filled),
        StringIndexer(
            inputCols=categories, outputCols=indexed, handleInvalid="keep", stringOrderType="frequencyDesc"
        ),
    ]
    encoded = indexed
    if one_hot:
        encoded = [f"{c}_hot" for c in categories]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
    return [*stages, VectorAssembler(inputCols=[*filled, *encoded], outputCol="features")]


def training_window(features: DataFrame, as_of: date, months: int = 6) -> DataFrame:
    """Feature rows of the last months before ``as_of``, stored and split into training and evaluation rows: exactly the last fifth of
    them, by day, product, name and category, is held out."""
    recent = features.where(in_window("sale_date", as_of, months=months) & (F.col("sale_date") < F.lit(as_of)))
    typed = _doubles(recent, SALES_NUMBERS).withColumn("label", F.col("daily_sales").cast("double"))
    return seq_split_rows(stored(typed, "training_window"))


def _training_rows(rows: DataFrame) -> DataFrame:
    """Training rows stored and read back in files of a useful size, for estimators that pass over them many times. A cached plan keeps
    all its shuffle partitions, however small, and every pass of a fit would send a result of each to the driver. A few of them do no harm."""
    if int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) <= FEW_PARTITIONS:
        return rows
    return stored(rows, "training_rows")


def _fit(stages: list, training: DataFrame) -> PipelineModel:
    """Fit with the training rows cached: the estimators pass over them many times."""
    training = training.persist()
    try:
        return Pipeline(stages=stages).fit(training)
    finally:
        training.unpersist()


def _bins(training: DataFrame, categories: list[str]) -> int:
    """Tree bins: at least 64, and one per category plus one for unseen values, which trees require."""
    counts = training.agg(*[F.countDistinct(c) for c in categories]).first()
    return max(64, max(counts) + 2)


def fit_linear(split: DataFrame) -> PipelineModel:
    stages = [*_inputs(SALES_NUMBERS, SALES_CATEGORIES, one_hot=True), LinearRegression(labelCol="label")]
    return _fit(stages, split.where(~F.col("is_eval")))


def fit_boosted(split: DataFrame, iterations: int = 50, learning_rate: float = 0.1) -> PipelineModel:
    training = split.where(~F.col("is_eval")).persist()
    trees = GBTRegressor(
        labelCol="label", maxIter=iterations, stepSize=learning_rate, maxBins=_bins(training, SALES_CATEGORIES), seed=42
    )
    return _fit([*_inputs(SALES_NUMBERS, SALES_CATEGORIES, one_hot=False), trees], training)


def predict_sales(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predicted beside actual units for feature rows."""
    return model.transform(rows).select(
        "product_id",
        "product_name",
        "category",
        "sale_date",
        "daily_sales",
        F.col("prediction").alias("predicted_daily_sales"),
    )


def evaluation_metrics(predictions: DataFrame, model_name: str) -> DataFrame:
    """One row of regression metrics. The two columns they need are stored: the means take one pass, the exact median a few more, each
    of which only counts."""
    values = stored(
        predictions.select(F.col("daily_sales").cast("double").alias("actual"), F.col("predicted_daily_sales").alias("predicted")),
        "predictions",
    )
    actual, predicted = F.col("actual"), F.col("predicted")
    error = actual - predicted
    log_error = F.log1p(actual) - F.log1p(F.greatest(predicted, F.lit(0.0)))
    spread = F.var_pop(actual)
    return values.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        F.lit(exact_median(values, F.abs(error))).cast("double").alias("median_absolute_error"),
        (1 - F.try_divide(F.avg(error * error), spread)).alias("r2_score"),
        (1 - F.try_divide(F.var_pop(error), spread)).alias("explained_variance"),
    ).select(F.lit(model_name).alias("model_name"), "*")


def model_evaluation(split: DataFrame, boosted: PipelineModel, linear: PipelineModel) -> DataFrame:
    """Both models on the held-out rows."""
    held_out = split.where("is_eval")
    return evaluation_metrics(predict_sales(boosted, held_out), "Boosted Tree").unionByName(
        evaluation_metrics(predict_sales(linear, held_out), "Linear Regression")
    )


def feature_weights(model: PipelineModel, training: DataFrame) -> DataFrame:
    """(feature, weight) rows: tree importances, or linear coefficients in units of a feature's deviation.

    The vector's slots are named by the assembler's own metadata.
    """
    fitted = model.stages[-1]
    transformed = model.transform(training)
    attributes = transformed.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    if hasattr(fitted, "featureImportances"):
        weights = fitted.featureImportances.toArray()
    else:
        scaler = StandardScaler(inputCol="features", outputCol="scaled").fit(transformed)
        weights = fitted.coefficients.toArray() * scaler.std.toArray()
    spark = training.sparkSession
    rows = [(names[i], float(w)) for i, w in enumerate(weights)]  # one entry per model input
    return spark.createDataFrame(rows, "feature string, weight double").orderBy(F.desc(F.abs("weight")), "feature")


def cluster_features(
    cleaned: DataFrame, as_of: date, months: int = 3, keys: Sequence[str] = ("product_id", "product_name", "category")
) -> DataFrame:
    """Per product: mean price, units, rating, discount and number of rows. Segments are learned with the product id as
    the only key, so that a renamed product counts once, and given to the finer rows."""
    return (
        cleaned.where(in_window("sale_date", as_of, months=months))
        .groupBy(*keys)
        .agg(
            exact_avg("price").alias("avg_price"),
            F.avg("sales_count").alias("avg_sales"),
            exact_avg("rating").alias("avg_rating"),
            exact_avg("discount_percent").alias("avg_discount"),
            F.count("*").alias("frequency"),
        )
    )


def fit_clusters(products: DataFrame, k: int = 5) -> PipelineModel:
    """Standardised k-means; products without a rating or discount take the mean."""
    filled = [f"{n}_filled" for n in CLUSTER_COLUMNS]
    stages = [
        Imputer(strategy="mean", inputCols=CLUSTER_COLUMNS, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        KMeans(k=k, seed=42, featuresCol="scaled", predictionCol="cluster"),
    ]
    return _fit(stages, _training_rows(_doubles(products, CLUSTER_COLUMNS)))


def _stable_number(model: PipelineModel) -> Column:
    """Cluster ids renumbered from 1 by ascending centre price, then units, so that refits keep their meaning."""
    centres = model.stages[-1].clusterCenters()  # k short vectors
    by_price = sorted(range(len(centres)), key=lambda i: (centres[i][0], centres[i][1]))
    number = {cluster: place for place, cluster in enumerate(by_price, start=1)}
    return F.element_at(F.array(*[F.lit(number[i]) for i in range(len(centres))]), F.col("cluster") + 1)


def product_clusters(model: PipelineModel, products: DataFrame) -> DataFrame:
    scored = model.transform(_doubles(products, CLUSTER_COLUMNS))
    return scored.select(
        "product_id", "product_name", "category", *CLUSTER_COLUMNS, _stable_number(model).alias("segment")
    )


def product_segments(model: PipelineModel, products: DataFrame) -> DataFrame:
    return product_clusters(model, products).withColumn("segment_name", segment_name(F.col("segment")))


def price_rows(cleaned: DataFrame, as_of: date, months: int = 3, scored_days: int = 30) -> DataFrame:
    """Price rows of the last months. Those of the last ``scored_days`` are to be scored (``is_new``); the model learns from
    the earlier ones, so that an odd price does not pull its own expectation."""
    recent = cleaned.where(in_window("sale_date", as_of, months=months))
    new = in_window("sale_date", as_of, days=scored_days)
    return _doubles(recent, PRICE_NUMBERS).withColumns({"label": F.col("price"), "is_new": new})


def fit_price(rows: DataFrame) -> PipelineModel:
    training = _training_rows(rows.where(~F.col("is_new")))
    trees = GBTRegressor(labelCol="label", maxIter=20, maxBins=_bins(training, PRICE_CATEGORIES), seed=42)
    return _fit([*_inputs(PRICE_NUMBERS, PRICE_CATEGORIES, one_hot=False), trees], training)


def predict_price(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows.where("is_new")).select(
        "product_id",
        "product_name",
        "category",
        "sale_date",
        "price",
        F.col("prediction").alias("expected_price"),
    )


def _with_zscore(rows: DataFrame, value: str) -> DataFrame:
    """Add the z-score of a column within its category.

    The two moments per category are an aggregate with map-side partials. They are stored first, one row per category: then
    their size is known and Spark broadcasts them while they are small, so the rows do not move, and a category with most of
    the rows is neither sorted nor gathered. Exact sums keep the score the same on every run. The rows are stored as well, so that
    what makes them runs once.
    """
    rows = stored(rows, "scored")
    x = F.col(value).cast("decimal(14,2)")
    n, total, squares = F.count(x), F.sum(x).cast("double"), F.sum(x * x).cast("double")
    mean = total / n
    moments = stored(
        rows.groupBy("category").agg(
            mean.alias("mean"), F.sqrt(F.try_divide(squares - total * mean, n - 1)).alias("deviation")
        ),
        "moments",
    )
    score = F.try_divide(F.col(value) - F.col("mean"), F.col("deviation"))
    return rows.join(moments, "category").withColumn("z_score", score).drop("mean", "deviation")


def price_anomalies(predictions: DataFrame, limit: float = 3.0) -> DataFrame:
    """Rows whose price is far from the model's expectation, by the residual's z-score in the category."""
    residual = F.round(F.col("price") - F.col("expected_price"), 2)
    scored = _with_zscore(predictions.withColumn("residual", residual), "residual")
    return scored.where(F.abs("z_score") > limit)


def price_zscore(cleaned: DataFrame, limit: float) -> DataFrame:
    """Rows whose price is far from the category's mean; needs no model."""
    rows = cleaned.select("product_id", "category", "sale_date", "price")
    return _with_zscore(rows, "price").where(F.abs("z_score") > limit)


def forecast_grid(features: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """The newest feature row of each product for ``as_of`` and the following days, with each day's calendar values; lags and averages
    stay as they are. The rank filter keeps one row per product and task before the shuffle."""
    newest = W.partitionBy("product_id").orderBy(F.desc("sale_date"), "product_name", "category")
    past = features.where(F.col("sale_date") <= F.lit(as_of))
    latest = past.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
    ahead = F.sequence(F.lit(as_of), F.date_add(F.lit(as_of), days))
    return latest.withColumn("prediction_date", F.explode(ahead)).withColumns(
        {
            "day_of_week": F.dayofweek("prediction_date"),
            "month": F.month("prediction_date"),
            "is_weekend": is_weekend("prediction_date"),
        }
    )


_PREDICTION = ["prediction_date", "product_id", "product_name", "category"]


def sales_forecast(model: PipelineModel, features: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Predicted units per product for ``as_of`` and the following days."""
    grid = forecast_grid(features, as_of, days)
    return model.transform(_doubles(grid, SALES_NUMBERS)).select(*_PREDICTION, F.col("prediction").alias("predicted_daily_sales"))


def average_forecast(features: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """The mean of a product's last seven rows as the prediction: a yardstick for the models that needs no fit."""
    return forecast_grid(features, as_of, days).select(*_PREDICTION, F.col("sales_ma_7").alias("predicted_daily_sales"))


def prediction_insights(predictions: DataFrame, as_of: date, days: int = 7, limit: int = 10) -> DataFrame:
    """The highest predictions of the coming days, in whole units."""
    ahead = F.col("prediction_date").between(F.lit(as_of), F.date_add(F.lit(as_of), days))
    return (
        predictions.where(ahead)
        .orderBy(F.desc("predicted_daily_sales"), "product_id", "prediction_date")
        .limit(limit)
        .select(
            "product_name", "category", "prediction_date", F.round("predicted_daily_sales", 0).alias("predicted_sales")
        )
    )


def prediction_check(predictions: DataFrame, as_of: date, limit: int = 10) -> DataFrame:
    """The highest predictions from ``as_of`` on."""
    return (
        predictions.where(F.col("prediction_date") >= F.lit(as_of))
        .orderBy(F.desc("predicted_daily_sales"), "product_id", "prediction_date")
        .limit(limit)
        .select("product_name", "prediction_date", "predicted_daily_sales")
    )
