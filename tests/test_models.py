from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pasarlens.plans import features, models

AS_OF = date(2024, 7, 1)


@pytest.fixture(scope="module")
def split(spark):
    """Twenty products with a weekly rhythm over half a year."""
    days = spark.range(180).select(F.date_sub(F.lit(AS_OF), (F.col("id") + 1).cast("int")).alias("sale_date"))
    units = 20 + F.col("p") * 3 + F.dayofweek("sale_date") * 4
    cleaned = days.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(19)))).select(
        F.format_string("PROD%05d", "p").alias("product_id"),
        F.format_string("name %d", "p").alias("product_name"),
        F.when(F.col("p") < 10, "A").otherwise("B").alias("category"),
        "sale_date",
        (30000.0 + F.col("p") * 15000).alias("price"),
        F.when(F.col("p") != 3, 10.0).alias("discount_percent"),
        units.cast("bigint").alias("sales_count"),
        F.lit(4.0).alias("rating"),
        F.lit(7).cast("bigint").alias("review_count"),
    )
    return cleaned, models.training_window(features.ml_features(cleaned), AS_OF)


def test_models_learn_the_rhythm(split):
    _, rows = split
    held_out = rows.where("is_eval")
    share = held_out.count() / rows.count()
    assert 0.2 <= share < 0.22
    linear, boosted = models.fit_linear(rows), models.fit_boosted(rows, iterations=10)
    metrics = {r.model_name: r for r in models.model_evaluation(rows, boosted, linear).collect()}
    assert metrics["Linear Regression"].r2_score > 0.8
    assert metrics["Boosted Tree"].r2_score > 0.8
    for row in metrics.values():
        assert row.mean_squared_error >= row.mean_absolute_error**2
        assert row.explained_variance >= row.r2_score - 1e-9
    weights = models.feature_weights(boosted, rows).collect()
    assert sum(r.weight for r in weights) == pytest.approx(1.0)
    assert {"sales_lag_7_filled", "category_index"} <= {r.feature for r in weights}
    named = {r.feature for r in models.feature_weights(linear, rows).collect()}
    assert any(n.startswith("category_hot") for n in named)


def test_forecast_has_every_product_and_day(split):
    cleaned, rows = split
    model = models.fit_boosted(rows, iterations=5)
    forecast = models.sales_forecast(model, features.ml_features(cleaned), AS_OF)
    assert forecast.count() == 20 * 8
    assert forecast.select("prediction_date").distinct().count() == 8
    top = models.prediction_insights(forecast, AS_OF).collect()
    assert len(top) == 10
    assert top[0].predicted_sales == max(r.predicted_sales for r in top)
    later = models.prediction_check(forecast, AS_OF + timedelta(days=5)).collect()
    assert all(r.prediction_date >= AS_OF + timedelta(days=5) for r in later)


def test_segments_are_numbered_by_price(split):
    cleaned, _ = split
    products = models.cluster_features(cleaned, AS_OF)
    segments = models.product_segments(models.fit_clusters(products), products).collect()
    assert len(segments) == 20
    means = {}
    for row in segments:
        means.setdefault(row.segment, []).append(row.avg_price)
    order = [sum(v) / len(v) for _, v in sorted(means.items())]
    assert order == sorted(order)
    assert {r.segment_name for r in segments if r.segment == 3} <= {"Best Sellers"}


def test_price_irregularities(spark, split):
    cleaned, _ = split
    odd = cleaned.limit(1).withColumns({"price": F.lit(9e6), "product_id": F.lit("odd"), "category": F.lit("A")})
    rows = cleaned.unionByName(odd)
    assert [r.product_id for r in models.price_zscore(rows, 3.0).collect()] == ["odd"]
    scored = models.price_rows(rows, AS_OF)
    found = models.price_anomalies(models.predict_price(models.fit_price(scored), scored))
    assert {r.product_id for r in found.collect()} == {"odd"}
