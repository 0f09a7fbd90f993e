"""Model queries. A model is fitted once per session and data set and then used by every query that needs it, as a
stored model would be."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from pasarlens.catalog import datasets as d
from pasarlens.catalog.datasets import AS_OF
from pasarlens.catalog.snapshots import FEATURES_SQL, Z_LIMIT
from pasarlens.plans import attributions, model_store
from pasarlens.plans import features as f
from pasarlens.plans import models as m
from pasarlens.session import fresh_path
from pasarlens.sources.tables import stored

_fitted: dict[tuple[str, str, str], object] = {}


def _once(spark, sf, name: str, fit: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _fitted:
        _fitted[key] = fit()
    return _fitted[key]


def forget() -> None:
    """Drop the fitted models and their rows, so that the next query makes its own."""
    _fitted.clear()


def _cleaned(spark, sf):
    """Cleaned rows dealt out by product and day, by which the features group them."""
    return d.cleaned(spark, sf, ("product_id", "sale_date"))


def _history(spark, sf):
    """All feature rows, stored for what needs both the rows to learn from and the newest ones."""
    return _once(spark, sf, "history", lambda: stored(f.feature_history(_cleaned(spark, sf)), "feature_history"))


def _features(spark, sf):
    """Feature rows with an earlier day, of the stored ones if there are any."""
    if (spark.sparkContext.applicationId, sf, "history") in _fitted:
        return f.with_earlier_day(_history(spark, sf))
    return f.ml_features(_cleaned(spark, sf))


def _split(spark, sf):
    """Training and evaluation rows, stored once for the fits and everything that uses them."""
    return _once(spark, sf, "split", lambda: m.training_window(_features(spark, sf), AS_OF))


def _linear(spark, sf):
    return _once(spark, sf, "linear", lambda: m.fit_linear(_split(spark, sf)))


def _boosted(spark, sf):
    return _once(spark, sf, "boosted", lambda: m.fit_boosted(_split(spark, sf)))


def _products(spark, sf):
    return m.cluster_features(d.cleaned(spark, sf), AS_OF)


def _clusters(spark, sf):
    products = m.cluster_features(d.cleaned(spark, sf), AS_OF, keys=("product_id",))
    return _once(spark, sf, "clusters", lambda: m.fit_clusters(products))


def _price_rows(spark, sf):
    return m.price_rows(d.cleaned(spark, sf), AS_OF)


def _price(spark, sf):
    return _once(spark, sf, "price", lambda: m.fit_price(_price_rows(spark, sf)))


def _forecast(spark, sf):
    history = _history(spark, sf)
    return m.sales_forecast(_boosted(spark, sf), history, AS_OF)


def _average_forecast(spark, sf):
    return m.average_forecast(f.feature_history(_cleaned(spark, sf)), AS_OF)


def _expected_prices(spark, sf):
    return m.predict_price(_price(spark, sf), _price_rows(spark, sf))


def model_refresh(spark, sf):
    """The weekly refresh; rows of the tables whose size does not depend on what a model says."""
    warehouse = fresh_path(spark, "warehouse")
    model_store.refresh_models(spark, d.cleaned(spark, sf), warehouse, AS_OF, Z_LIMIT, by_product_day=_cleaned(spark, sf))
    return model_store.stored_rows(
        spark, warehouse, ("feature_history", "model_evaluation", "product_segments", "sales_predictions")
    )


def _naive(split):
    """Units of the row before as the prediction, for the rows held out."""
    return split.where("is_eval").select(
        "product_id", "sale_date", "daily_sales", F.col("sales_lag_1").cast("double").alias("predicted_daily_sales")
    )


def naive_evaluation(spark, sf):
    """The metrics of a prediction that SQL can make too."""
    return m.evaluation_metrics(_naive(_split(spark, sf)), "Last value").select(
        "model_name", *[F.round(c, 6).alias(c) for c in _METRICS]
    )


def fixed_price_anomalies(spark, sf):
    """Price anomalies against a fixed expectation: the price before, as the snapshot states it."""
    rows = d.cleaned(spark, sf).select(
        "product_id", "product_name", "category", "sale_date", "price", F.lit(50000.0).alias("expected_price")
    )
    return m.price_anomalies(rows, Z_LIMIT).select("product_id", "category", "sale_date", "price", "residual")


_ROW = ["product_id", "product_name", "category", "sale_date"]


def _tree_attributions(spark, sf):
    return attributions.tree_attributions(_boosted(spark, sf), _split(spark, sf).where("is_eval"), _ROW)


def _linear_attributions(spark, sf):
    split = _split(spark, sf)
    return attributions.linear_attributions(_linear(spark, sf), split.where("is_eval"), split.where("NOT is_eval"), _ROW)


def _sums(attributed):
    """Whether each row's attributions make its prediction."""
    return attributed[0].select(*_ROW, attributions.adds_up().alias("adds_up"))


_METRICS = ["mean_absolute_error", "mean_squared_error", "mean_squared_log_error", "median_absolute_error", "r2_score", "explained_variance"]

QUERIES = {
    "model_refresh": model_refresh,
    "training_rows": lambda spark, sf: _split(spark, sf).select("product_id", "category", "sale_date", "label", "is_eval"),
    "seq_split_rows": lambda spark, sf: f.seq_split_rows(stored(_features(spark, sf), "features")).select(*f.ROW_ORDER, "is_eval"),
    "naive_evaluation": naive_evaluation,
    "fixed_price_anomalies": fixed_price_anomalies,
    "forecast_grid": lambda spark, sf: _forecast(spark, sf).select("prediction_date", "product_id", "product_name", "category"),
    "segment_inputs": lambda spark, sf: m.cluster_features(d.cleaned(spark, sf), AS_OF, keys=("product_id",)),
    "segment_rows": lambda spark, sf: m.product_segments(_clusters(spark, sf), _products(spark, sf)).select(
        "product_id", "product_name", "category", F.col("segment").between(1, 5).alias("known_segment")
    ),
    "price_rows": lambda spark, sf: _expected_prices(spark, sf).select("product_id", "category", "sale_date", "price"),
    "tree_attribution_sums": lambda spark, sf: _sums(_tree_attributions(spark, sf)),
    "linear_attribution_sums": lambda spark, sf: _sums(_linear_attributions(spark, sf)),
    "tree_explanation": lambda spark, sf: attributions.global_attributions(*_tree_attributions(spark, sf)),
    "linear_explanation": lambda spark, sf: attributions.global_attributions(*_linear_attributions(spark, sf)),
    "sales_lr_predictions": lambda spark, sf: m.predict_sales(_linear(spark, sf), _split(spark, sf).where("is_eval")),
    "sales_gbt_predictions": lambda spark, sf: m.predict_sales(
        _boosted(spark, sf), _split(spark, sf).where("is_eval")
    ),
    "model_evaluation": lambda spark, sf: m.model_evaluation(
        _split(spark, sf), _boosted(spark, sf), _linear(spark, sf)
    ),
    "feature_weights": lambda spark, sf: m.feature_weights(_boosted(spark, sf), _split(spark, sf)),
    "linear_feature_weights": lambda spark, sf: m.feature_weights(_linear(spark, sf), _split(spark, sf)),
    "product_clusters": lambda spark, sf: m.product_clusters(_clusters(spark, sf), _products(spark, sf)),
    "product_segments": lambda spark, sf: m.product_segments(_clusters(spark, sf), _products(spark, sf)),
    "price_model": _expected_prices,
    "price_anomalies": lambda spark, sf: m.price_anomalies(_expected_prices(spark, sf), Z_LIMIT),
    "sales_forecast": _forecast,
    "average_forecast": _average_forecast,
    "average_insights": lambda spark, sf: m.prediction_insights(_average_forecast(spark, sf), AS_OF),
    "average_check": lambda spark, sf: m.prediction_check(_average_forecast(spark, sf), AS_OF),
    "prediction_insights": lambda spark, sf: m.prediction_insights(_forecast(spark, sf), AS_OF),
    "prediction_check": lambda spark, sf: m.prediction_check(_forecast(spark, sf), AS_OF),
}

_TODAY = "DATE '2001-08-01'"
_SPLIT_SQL = f"""
recent AS (
  SELECT * FROM features
  WHERE sale_date >= CAST({_TODAY} - INTERVAL 6 MONTH AS DATE) AND sale_date < {_TODAY}
),
split AS (
  SELECT *, row_number() OVER (ORDER BY sale_date, product_id, product_name, category) > count(*) OVER () * 0.8 AS is_eval
  FROM recent
)"""
_LAST_MONTHS = f"sale_date BETWEEN CAST({_TODAY} - INTERVAL 3 MONTH AS DATE) AND {_TODAY}"

_AVERAGE_SQL = f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL},
latest AS (
  SELECT * FROM (
    SELECT product_id, product_name, category, sales_ma_7,
           row_number() OVER (PARTITION BY product_id ORDER BY sale_date DESC, product_name, category) AS place
    FROM history WHERE sale_date <= {_TODAY})
  WHERE place = 1
),
forecast AS (
  SELECT CAST({_TODAY} + CAST(i AS INTEGER) AS DATE) AS prediction_date, product_id, product_name, category,
         sales_ma_7 AS predicted_daily_sales
  FROM latest, range(8) t(i)
)"""
_HIGHEST = "ORDER BY predicted_daily_sales DESC, product_id, prediction_date LIMIT 10"

ORACLE: dict[str, str] = {
    "average_forecast": f"{_AVERAGE_SQL} SELECT * FROM forecast",
    "average_insights": f"""{_AVERAGE_SQL}
SELECT product_name, category, prediction_date, round(predicted_daily_sales, 0) AS predicted_sales FROM forecast {_HIGHEST}""",
    "average_check": f"""{_AVERAGE_SQL}
SELECT product_name, prediction_date, predicted_daily_sales FROM forecast {_HIGHEST}""",
    "seq_split_rows": f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL}
SELECT sale_date, product_id, product_name, category,
       row_number() OVER (ORDER BY sale_date, product_id, product_name, category) > count(*) OVER () * 0.8 AS is_eval
FROM features""",
    **dict.fromkeys(("tree_attribution_sums", "linear_attribution_sums"), f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL}, {_SPLIT_SQL}
SELECT product_id, product_name, category, sale_date, true AS adds_up FROM split WHERE is_eval"""),
    "training_rows": f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL}, {_SPLIT_SQL}
SELECT product_id, category, sale_date, CAST(daily_sales AS DOUBLE) AS label, is_eval FROM split""",
    "naive_evaluation": f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL}, {_SPLIT_SQL},
e AS (
  SELECT CAST(daily_sales AS DOUBLE) AS y, CAST(sales_lag_1 AS DOUBLE) AS p,
         CAST(daily_sales AS DOUBLE) - sales_lag_1 AS err FROM split WHERE is_eval
)
SELECT 'Last value' AS model_name, round(avg(abs(err)), 6) AS mean_absolute_error,
       round(avg(err * err), 6) AS mean_squared_error,
       round(avg((ln(1 + y) - ln(1 + p)) * (ln(1 + y) - ln(1 + p))), 6) AS mean_squared_log_error,
       round(median(abs(err)), 6) AS median_absolute_error,
       round(1 - avg(err * err) / nullif(var_pop(y), 0), 6) AS r2_score,
       round(1 - var_pop(err) / nullif(var_pop(y), 0), 6) AS explained_variance
FROM e""",
    "fixed_price_anomalies": f"""
WITH {d.CLEANED_SQL},
r AS (SELECT *, round(price - 50000.0, 2) AS residual FROM cleaned),
sums AS (
  SELECT category, count(residual) AS n, CAST(sum(CAST(residual AS DECIMAL(14,2))) AS DOUBLE) AS total,
         CAST(sum(CAST(residual AS DECIMAL(14,2)) * CAST(residual AS DECIMAL(14,2))) AS DOUBLE) AS squares
  FROM r GROUP BY category
),
moments AS (
  SELECT category, total / n AS mean, sqrt((squares - total * (total / n)) / nullif(n - 1, 0)) AS deviation FROM sums
)
SELECT product_id, category, sale_date, price, residual FROM r JOIN moments USING (category)
WHERE abs((residual - mean) / deviation) > {Z_LIMIT}""",
    "forecast_grid": f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL},
latest AS (
  SELECT * FROM (
    SELECT product_id, product_name, category,
           row_number() OVER (PARTITION BY product_id ORDER BY sale_date DESC, product_name, category) AS place
    FROM history WHERE sale_date <= {_TODAY})
  WHERE place = 1
)
SELECT CAST({_TODAY} + CAST(i AS INTEGER) AS DATE) AS prediction_date, product_id, product_name, category
FROM latest, range(8) t(i)""",
    "segment_inputs": f"""
WITH {d.CLEANED_SQL}
SELECT product_id, {d.sql_avg("price")} AS avg_price, CAST(sum(sales_count) AS DOUBLE) / count(*) AS avg_sales,
       {d.sql_avg("rating")} AS avg_rating, {d.sql_avg("discount_percent")} AS avg_discount, count(*) AS frequency
FROM cleaned WHERE {_LAST_MONTHS} GROUP BY product_id""",
    "segment_rows": f"""
WITH {d.CLEANED_SQL}
SELECT product_id, product_name, category, true AS known_segment
FROM cleaned WHERE {_LAST_MONTHS} GROUP BY product_id, product_name, category""",
    "price_rows": f"""
WITH {d.CLEANED_SQL}
SELECT product_id, category, sale_date, price FROM cleaned WHERE sale_date BETWEEN {_TODAY} - 30 AND {_TODAY}""",
    "model_refresh": f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL}
SELECT 'feature_history' AS table_name, count(*) AS "rows" FROM history
UNION ALL SELECT 'model_evaluation', 2 FROM (SELECT count(*) FROM cleaned)
UNION ALL SELECT 'product_segments', count(*) FROM (
  SELECT 1 FROM cleaned WHERE {_LAST_MONTHS} GROUP BY product_id, product_name, category)
UNION ALL SELECT 'sales_predictions', 8 * count(DISTINCT product_id) FROM history WHERE sale_date <= {_TODAY}""",
}
