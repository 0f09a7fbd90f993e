"""The weekly model refresh: features, models, their evaluation and their results as stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.plans import models as m
from pasarlens.plans.features import feature_history, with_earlier_day
from pasarlens.sources.tables import replace_table, stored

MODELS = ("linear_regression", "boosted_tree", "product_clusters", "price_model")
TABLES = ("feature_history", "model_evaluation", "product_segments", "sales_predictions", "price_anomalies")


def _model_path(warehouse: str, name: str) -> str:
    return f"{warehouse}/models/{name}"


def load_model(warehouse: str, name: str) -> PipelineModel:
    return PipelineModel.load(_model_path(warehouse, name))


def _keep(model: PipelineModel, warehouse: str, name: str) -> PipelineModel:
    """The stored model, so that everything after it uses what a later run will load."""
    model.write().overwrite().save(_model_path(warehouse, name))
    return load_model(warehouse, name)


def refresh_models(
    spark: SparkSession, cleaned: DataFrame, warehouse: str, as_of: date, anomaly_limit: float = 3.0, by_product_day: DataFrame | None = None
) -> None:
    """Fit all models on what is known up to ``as_of`` and replace the stored models and tables.

    Features are computed once and stored by month; training reads only the months it needs, and the models, their
    evaluation, segments, forecasts and price anomalies are read back from tables like any other. ``by_product_day`` are the cleaned rows
    dealt out by product and day, if there are such: the features take them in one shuffle less.

    Features are stored twice. As they are made, the rows of a product lie together, and the newest of each are found where they lie for
    the forecasts; among the months no two rows of a product need be in one file, and nearly all of them would be shuffled for that.
    """
    features_path = f"{warehouse}/feature_history"
    history = stored(feature_history(cleaned if by_product_day is None else by_product_day), "feature_history")
    replace_table(history.withColumn("sale_month", F.trunc("sale_date", "month")), features_path, "sale_month", ("product_id",))
    since = F.trunc(F.add_months(F.lit(as_of), -6), "month")
    recent = with_earlier_day(spark.read.parquet(features_path).where(F.col("sale_month") >= since)).drop("sale_month")
    split = m.training_window(recent, as_of)
    linear = _keep(m.fit_linear(split), warehouse, "linear_regression")
    boosted = _keep(m.fit_boosted(split), warehouse, "boosted_tree")
    replace_table(m.model_evaluation(split, boosted, linear), f"{warehouse}/model_evaluation")
    replace_table(m.sales_forecast(boosted, history, as_of), f"{warehouse}/sales_predictions")

    by_product = m.cluster_features(cleaned, as_of, keys=("product_id",))
    clusters = _keep(m.fit_clusters(by_product), warehouse, "product_clusters")
    replace_table(m.product_segments(clusters, m.cluster_features(cleaned, as_of)), f"{warehouse}/product_segments")

    rows = m.price_rows(cleaned, as_of)
    prices = _keep(m.fit_price(rows), warehouse, "price_model")
    replace_table(m.price_anomalies(m.predict_price(prices, rows), anomaly_limit), f"{warehouse}/price_anomalies")


def stored_rows(spark: SparkSession, warehouse: str, names: tuple[str, ...] = TABLES) -> DataFrame:
    """Rows of each stored table."""
    counts = [
        spark.read.parquet(f"{warehouse}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        for name in names
    ]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out
