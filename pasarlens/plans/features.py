"""Time-series features per product and day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pasarlens.functions import exact_avg, is_weekend, price_category
from pasarlens.operators.ranks import numbered
from pasarlens.sources.tables import stored

LAGS = (1, 7, 30)
AVERAGES = (7, 30)


def _by_product_day(cleaned: DataFrame, *extra) -> DataFrame:
    return cleaned.groupBy("product_id", "product_name", "category", "sale_date").agg(
        exact_avg("price").alias("avg_price"),
        exact_avg("discount_percent").alias("avg_discount"),
        F.sum("sales_count").alias("daily_sales"),
        exact_avg("rating").alias("avg_rating"),
        *extra,
    )


def _history():
    """Rows of a product by day. The input is already one row per product, name, category and day, so the longest
    partition is bounded by the number of days, however many raw rows a product has."""
    return W.partitionBy("product_id").orderBy("sale_date", "product_name", "category")


def _lag_columns() -> dict:
    return {f"sales_lag_{n}": F.lag("daily_sales", n).over(_history()) for n in LAGS}


def _average_columns() -> dict:
    return {f"sales_ma_{n}": F.avg("daily_sales").over(_history().rowsBetween(1 - n, 0)) for n in AVERAGES}


def product_days(cleaned: DataFrame) -> DataFrame:
    """Units per product and day."""
    return cleaned.groupBy("product_id", "product_name", "category", "sale_date").agg(
        F.sum("sales_count").alias("daily_sales")
    )


def sales_lags(days: DataFrame) -> DataFrame:
    """Units 1, 7 and 30 rows earlier; rows, not calendar days."""
    return days.withColumns(_lag_columns())


def moving_averages(days: DataFrame) -> DataFrame:
    """Mean units over the last 7 and 30 rows, over fewer at the start."""
    return days.withColumns(_average_columns())


def calendar_features(cleaned: DataFrame) -> DataFrame:
    """Product-day measures with weekday, month and weekend flag."""
    return _by_product_day(cleaned).withColumns(
        {
            "day_of_week": F.dayofweek("sale_date"),
            "month": F.month("sale_date"),
            "is_weekend": is_weekend("sale_date"),
        }
    )


def _with_calendar(days: DataFrame) -> DataFrame:
    """What follows from a row's own day and price, after the measures."""
    added = {
        "day_of_week": F.dayofweek("sale_date"),
        "day_of_month": F.dayofmonth("sale_date"),
        "month": F.month("sale_date"),
        "year": F.year("sale_date"),
        "is_weekend": is_weekend("sale_date"),
        "price_category": price_category(F.col("avg_price")),
    }
    place = days.columns.index("review_count") + 1
    return days.select(*days.columns[:place], *[c.alias(n) for n, c in added.items()], *days.columns[place:])


def _measured_days(cleaned: DataFrame) -> DataFrame:
    return _by_product_day(cleaned, F.max("review_count").alias("review_count"))


def feature_history(cleaned: DataFrame) -> DataFrame:
    """All feature rows, the first day of a product (which has no lag) included. Calendar columns are added after the windows, so that
    they are neither shuffled nor sorted."""
    return _with_calendar(_measured_days(cleaned).withColumns({**_lag_columns(), **_average_columns()}))


def with_earlier_day(history: DataFrame) -> DataFrame:
    return history.where(F.col("sales_lag_1").isNotNull())


def ml_features(cleaned: DataFrame) -> DataFrame:
    """Feature rows that have at least one earlier day."""
    return with_earlier_day(feature_history(cleaned))


def seq_split(rows: DataFrame, day: str = "sale_date", eval_fraction: float = 0.2) -> DataFrame:
    """Flag the latest part of the rows as evaluation data.

    Rows are counted per day first, so the running share is taken over one row per calendar day. The flags go back
    by an equi-join with the day table broadcast: it holds one date and one boolean per calendar day, a few
    thousand rows for decades of data however many rows a day has, so the rows are not shuffled by day. All rows of
    a day land on the same side; the first day whose running share passes ``1 - eval_fraction`` starts the
    evaluation part.
    """
    per_day = rows.where(F.col(day).isNotNull()).groupBy(day).agg(F.count("*").alias("n"))
    all_days = W.partitionBy(F.lit(0))
    so_far = F.sum("n").over(all_days.orderBy(day))
    flags = per_day.select(day, (so_far > F.sum("n").over(all_days) * (1 - eval_fraction)).alias("is_eval"))
    return rows.join(F.broadcast(flags), day)


#: Rows of a product that later lags and averages look back to.
TAIL_ROWS = max(*LAGS, *AVERAGES)
_TAIL = ["product_id", "product_name", "category", "sale_date", "daily_sales"]


def advance_features(cleaned: DataFrame, root: str, since: date | None, until: date) -> None:
    """Bring stored features forward to ``until`` with the rows of the days after ``since``.

    Beside the features a tail is kept, the last ``TAIL_ROWS`` rows of each product; lags and averages of the new days need nothing older,
    so that a step reads the tail and its own days, however long the history is. The first step has no ``since``. A step
    replaces what an earlier run of the same step has written. Days must be complete when their step runs.

    The tail and the new days are gathered by product and sorted once: the windows that make the features also tell which rows are the
    next tail. Features and tail are copied from what this pass stores; calendar columns are added to the copy. A step of so few rows that
    most products get none, as that of a day, leaves the tails of those out of the pass.
    """
    spark = cleaned.sparkSession
    day = F.col("sale_date")
    own = cleaned.where(day <= F.lit(until))
    own = own if since is None else own.where(day > F.lit(since))
    days, rest = _measured_days(own), None
    if since is not None:
        days = stored(days, "feature_days")
        tail = spark.read.parquet(f"{root}/tail/upto={since}")
        if days.count() * 2 * TAIL_ROWS < tail.count():  # fewer rows than half of the products
            touched = days.select(F.col("product_id").alias("_touched")).distinct()
            same = F.col("product_id").eqNullSafe(F.col("_touched"))
            tail, rest = tail.join(touched, same, "left_semi"), tail.join(touched, same, "left_anti")
        days = days.withColumn("_new", F.lit(True)).unionByName(tail.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    else:
        days = days.withColumn("_new", F.lit(True))
    in_tail = F.lead("_new", TAIL_ROWS).over(_history()).isNull()
    rows = days.withColumns({**_lag_columns(), **_average_columns(), "_in_tail": in_tail})
    rows = stored(rows.where(F.col("_new") | F.col("_in_tail")), "feature_rows")
    new = _with_calendar(rows.where("_new").drop("_new", "_in_tail"))
    new.write.mode("overwrite").parquet(f"{root}/features/upto={until}")
    last = rows.where("_in_tail").select(*_TAIL)
    last = last if rest is None else last.unionByName(rest)
    last.write.mode("overwrite").parquet(f"{root}/tail/upto={until}")


def advanced_features(spark: SparkSession, root: str) -> DataFrame:
    """The feature rows of all steps."""
    return spark.read.parquet(f"{root}/features").drop("upto")


#: What orders the feature rows; no two of them agree in all of it.
ROW_ORDER = ("sale_date", "product_id", "product_name", "category")


def seq_split_rows(rows: DataFrame, order: Sequence[str] = ROW_ORDER, eval_fraction: float = 0.2) -> DataFrame:
    """Flag exactly the last ``eval_fraction`` of the rows (rounded up) by an order that leaves no ties.

    No row is moved: the first evaluation row is found, and each row is compared with it. Rows are counted per day; only
    the keys of the day that holds the boundary are ranked, by ranges and counts per range. Rows without a day are left out; of
    other null keys null comes first. Rows that agree in the whole order fall on one side. The rows are read three times, so they should be
    stored.
    """
    day, *keys = order
    known = rows.where(F.col(day).isNotNull())
    per_day = known.groupBy(day).agg(F.count("*").alias("n"))
    all_days = W.partitionBy(F.lit(0))
    running = per_day.select(
        day, F.sum("n").over(all_days.orderBy(day)).alias("until"), "n", F.sum("n").over(all_days).alias("total")
    )
    kept = F.floor(F.col("total") * F.lit(1 - Decimal(str(eval_fraction))))
    edge = running.where(F.col("until") > kept).select("*", kept.alias("kept")).orderBy(day).first()
    if edge is None:
        return known.withColumn("is_eval", F.lit(False))
    own = known.where(F.col(day) == F.lit(edge[day])).select(*keys)
    placed = numbered(own, [F.asc_nulls_first(k) for k in keys], "place")
    first = placed.where(F.col("place") == edge["kept"] - (edge["until"] - edge["n"])).first()
    types = {f.name: f.dataType for f in rows.schema}
    boundary = F.struct(*[F.lit(first[k]).cast(types[k]).alias(k) for k in keys])
    after = (F.col(day) > F.lit(edge[day])) | ((F.col(day) == F.lit(edge[day])) & (F.struct(*keys) >= boundary))
    return known.withColumn("is_eval", after)
