"""Fits, landed documents and limits of the third round of findings."""

from datetime import date, datetime

from pyspark.sql import functions as F

from pasarlens.catalog import learning
from pasarlens.operators.cleaning import clean_sales
from pasarlens.plans import features, models
from pasarlens.sources import landing, tables
from pasarlens.streaming import ingest


def test_training_rows_of_many_partitions_are_stored(spark):
    rows = spark.range(1000).groupBy("id").count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        kept = models._training_rows(rows)
        assert kept.inputFiles() and kept.persist().rdd.getNumPartitions() <= 16
        assert sorted(kept.collect()) == sorted(rows.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_documents_and_exports_are_compressed(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").alias("product_id"))
    landing.write_envelopes(rows, str(tmp_path / "in"), datetime(2001, 8, 1), "x")
    tables.backup_tables({"t": rows}, str(tmp_path / "b"), "s")
    for folder in ("in", "b"):
        files = [p for p in (tmp_path / folder).rglob("part-*")]
        assert files and all(p.name.endswith(".gz") for p in files)
    assert landing.envelope_records(landing.read_envelopes(spark, str(tmp_path / "in"))).count() == 20


def test_a_file_without_records_is_turned_away_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"metadata": {"source": "a"}}')
    (source / "b.json").write_text('{"metadata": {"source": "b"}, "data": []}')
    (source / "c.json").write_text('{"data": [{"product_id": "P", "product_name": "n", "price": 2, "category": "c"}, {"price": 1}]}')
    table, rejected = str(tmp_path / "t"), str(tmp_path / "r")
    ingest.ingest(ingest.stream_envelopes(spark, str(source)), table, rejected, str(tmp_path / "c"), date(2001, 8, 1))
    assert [r["product_id"] for r in spark.read.parquet(table).collect()] == ["P"]
    assert sorted(r["reason"] for r in spark.read.parquet(rejected).collect()) == ["missing key", "no data"]


def test_split_rows_are_made_once(spark):
    learning.forget()
    sf = "/root/testdata/sf0.001"
    split = learning._split(spark, sf)
    assert learning._split(spark, sf) is split
    learning.forget()


def test_features_of_gathered_rows_are_shuffled_twice(spark):
    kinds = "product_id string, product_name string, category string, price double, discount_percent double, sales_count bigint, rating double, review_count bigint, stock bigint, seller_name string, seller_location string, timestamp timestamp"
    row = ("P", "n", "c", 10.0, 5.0, 1, 4.0, 2, 3, "s", "l", datetime(2001, 7, 1))
    raw = spark.createDataFrame([row, row, (*row[:3], 20.0, *row[4:])], kinds)
    gathered = features.feature_history(clean_sales(raw, gather=("product_id", "sale_date")))
    plan = gathered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert gathered.collect() == features.feature_history(clean_sales(raw)).collect()
