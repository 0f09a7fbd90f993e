"""The physical plans keep the properties that matter at scale."""

import re

import pytest

import __spark_entry__ as registry
from pasarlens.catalog import datasets as d
from pasarlens.operators import keys
from pasarlens.plans import snapshot_reports
from pasarlens.sources import tables

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "category_sales", "top_sellers", "daily_sales_trends", "daily_summary", "transaction_profile", "enrich_sales",
    "review_category_summary", "top_rated_products", "review_daily_trends", "sentiment_share", "review_profile",
    "normalize_records", "clean_sales", "daily_category_summary", "product_performance", "weekly_trend",
    "daily_totals", "quality_report", "ml_features", "moving_averages", "seq_split", "price_zscore", "dedupe_last",
    "append_new", "upsert", "check_duplicates",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_windows_reach_the_scan(spark):
    text = plan(registry.queries()["daily_category_summary"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate,2001-07-02", text)


def test_unused_columns_are_not_read(spark):
    text = plan(registry.queries()["scheduled_rollup"](spark, SF_DIR).select("sale_date"))
    assert "l_tax" not in text and "l_returnflag" not in text


def test_partition_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    sales = d.sales(spark, SF_DIR).where("sale_date >= date'2001-07-01'")
    tables.replace_table(sales, path, "sale_date", ["category"])
    text = plan(tables.unexpired(spark.read.parquet(path), "sale_date", 30, d.AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*sale_date", text)


def test_duplicate_rows_are_cut_before_the_shuffle(spark):
    text = plan(keys.remove_duplicates(d.sales(spark, SF_DIR), "transaction_id"))
    assert text.index("Final") < text.index("Exchange hashpartitioning(transaction_id") < text.index("Partial")


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(registry.queries()["top_sellers"](spark, SF_DIR))


def test_day_totals_ship_one_row_per_category(spark):
    df = d.snapshots(spark, SF_DIR).selectExpr("*", "price * sales_count as revenue")
    text = plan(snapshot_reports.daily_totals(df))
    assert text.count("Exchange hashpartitioning(ingestion_date") == 2
    assert "partial_sum" in text


def test_price_scores_move_no_rows(spark):
    df = registry.queries()["price_zscore"](spark, SF_DIR)
    df.write.format("noop").mode("overwrite").save()
    text = plan(df)
    assert "BroadcastHashJoin [category" in text and "Exchange hashpartitioning(category" not in text


def test_split_flags_do_not_shuffle_the_rows(spark):
    text = plan(registry.queries()["seq_split"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin [sale_date" not in text
