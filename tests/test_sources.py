import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.plans import daily_job
from pasarlens.schemas import CATALOGUE, REVIEWS, SNAPSHOTS
from pasarlens.sources import delimited, landing, tables

AT = datetime(2024, 1, 2, 3, 4, 5)
LINES = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_envelopes_are_bounded_and_complete(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.range(0, 1000, 1, 3).select(F.lit("hot").alias("product_id"), F.lit(1.5).alias("price"))
    landing.write_envelopes(df, path, AT, "api", max_records=100)
    documents = landing.read_envelopes(spark, path)
    sizes = [(r[0], r[1]) for r in documents.select("metadata.record_count", F.size("data")).collect()]
    assert all(a == b <= 100 for a, b in sizes) and sum(b for _, b in sizes) == 1000
    records = landing.envelope_records(documents)
    assert records.count() == 1000
    ids = [r[0] for r in records.select("ingestion_id").distinct().collect()]
    assert len(ids) == len(sizes) and all(i.startswith("ING_20240102_030405_") for i in ids)


def test_landing_returns_its_metadata(spark, tmp_path):
    meta = landing.write_landing(spark.range(7), str(tmp_path / "raw"), AT, "sample")
    assert meta == {
        "ingestion_id": "ING_20240102_030405",
        "ingestion_timestamp": "2024-01-02T03:04:05",
        "record_count": 7,
        "source": "sample",
    }
    batches = landing.landing_batches(spark, str(tmp_path / "raw"), spark.range(1).schema)
    assert [tuple(r) for r in batches.collect()] == [("ING_20240102_030405", "sample", 7)]


def test_ndjson_tolerates_few_bad_lines_and_grows(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"a","n":1}\n{broken\n{"id":"b","n":2}\n')
    (tmp_path / "b.json").write_text('{"id":"c","n":3,"extra":"x"}\n')
    table, staging = str(tmp_path / "t"), str(tmp_path / "s")
    assert landing.load_ndjson(spark, str(tmp_path / "a.json"), table, staging, LINES) == {"loaded": 2, "bad": 1}
    wider = T.StructType([*LINES, T.StructField("extra", T.StringType())])
    landing.load_ndjson(spark, str(tmp_path / "b.json"), table, staging, wider)
    rows = sorted(tuple(r) for r in landing.read_growing_table(spark, table).select("id", "n", "extra").collect())
    assert rows == [("a", 1, None), ("b", 2, None), ("c", 3, "x")]


def test_ndjson_with_too_many_bad_lines_loads_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"a","n":1}\n' + "{broken\n" * 3)
    table = tmp_path / "t"
    with pytest.raises(landing.TooManyBadRecords):
        landing.load_ndjson(spark, str(tmp_path / "a.json"), str(table), str(tmp_path / "s"), LINES, max_bad_records=2)
    assert not table.exists()


def test_new_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    today = date.today()
    assert landing.new_files(spark, str(tmp_path), today - timedelta(days=1)).count() == 1
    assert landing.new_files(spark, str(tmp_path), today + timedelta(days=2)).count() == 0


def test_csv_keeps_month_text_and_multi_line_text(spark, tmp_path):
    path, table = str(tmp_path / "c"), str(tmp_path / "t")
    text = 'two\nlines, "quoted"'
    df = spark.createDataFrame([("2024-03", date(2024, 3, 1), 1.5, text)], "m string, d date, x double, t string")
    delimited.write_csv(df, path)
    loaded = delimited.load_csv(spark, path, table, multi_line=True)
    assert [f.dataType.simpleString() for f in loaded.schema] == ["string", "date", "double", "string"]
    assert tuple(loaded.first()) == ("2024-03", date(2024, 3, 1), 1.5, text)


def test_catalogue(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text(",".join(CATALOGUE.names) + "\nP1,Kopi,Minuman,10,12,3,Toko,Bogor,4.5,7\n")
    row = delimited.read_catalogue(spark, str(path)).first()
    assert (row.product_id, row.price, row.stock, row.rating) == ("P1", 10.0, 3, 4.5)


def daily(spark, n):
    return spark.range(n).select(
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 4).cast("int")).alias("d"), F.col("id").alias("v")
    )


def test_expiry_drops_old_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(daily(spark, 40), path, "d")
    assert tables.expire_partitions(spark, path, "d", 2, date(2024, 1, 4)) == 1
    left = spark.read.parquet(path)
    assert left.count() == 30 == tables.unexpired(daily(spark, 40), "d", 2, date(2024, 1, 4)).count()


def test_merge_moves_rows_between_partitions_with_escaped_names(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    odd = ["x/1", "x:1", "a b", "50%", "y"]
    rows = [(str(i), v, 0) for i, v in enumerate(odd)]
    tables.replace_table(spark.createDataFrame(rows, "id string, p string, v int"), path, "p")
    moved = spark.createDataFrame([(str(i), "y", 1) for i in range(4)] + [("new", "x/1", 1)], "id string, p string, v int")
    tables.upsert_table(spark, path, staging, moved, "id", ("p", "v"), "p")
    found = sorted((r.id, r.p, r.v) for r in spark.read.parquet(path).collect())
    assert found == [("0", "y", 1), ("1", "y", 1), ("2", "y", 1), ("3", "y", 1), ("4", "y", 0), ("new", "x/1", 1)]


def test_replace_partitions_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(daily(spark, 40), path, "d")
    part = daily(spark, 40).where("d = date'2024-01-02'").withColumn("v", F.lit(0).cast("bigint"))
    for _ in range(2):
        tables.replace_partitions(part, path, "d")
    table = spark.read.parquet(path)
    assert table.count() == 40 and table.where("v = 0 and d = date'2024-01-02'").count() == 10


def test_rewrite_in_place(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    tables.replace_table(daily(spark, 8), path)
    tables.rewrite_table(spark, path, staging, lambda t: t.where("v < 3"))
    assert spark.read.parquet(path).count() == 3


def test_backup_counts(spark, tmp_path):
    live = {"a": spark.range(3), "b": spark.range(0)}
    rows = tables.backup_tables(live, str(tmp_path), "20240101_000000")
    schemas = {name: df.schema for name, df in live.items()}
    report = tables.backup_report(spark, rows, schemas, str(tmp_path), "20240101_000000")
    assert {tuple(r) for r in report.collect()} == {("a", 3, 3), ("b", 0, 0)}


def test_stamp(spark):
    assert tables.stamp_ingestion(spark.range(1), date(2024, 1, 1)).first().ingestion_date == date(2024, 1, 1)


def test_conform_fills_optional_and_refuses_missing_required(spark):
    out = tables.conform(spark.createDataFrame([("1", "2")], "review_id string, rating string"), REVIEWS)
    assert out.columns == REVIEWS.names
    assert (out.first().rating, out.first().product_url) == (2, None)
    with pytest.raises(ValueError, match="review_id"):
        tables.conform(spark.range(1), REVIEWS)


def record(day, moment, **changes):
    row = {"product_id": "a", "product_name": "Kopi", "category": "food", "price": 10.0, "sales_count": 4,
           "timestamp": moment, "ingestion_date": day}
    return json.dumps({**row, **changes})


def test_run_day_keeps_steps_in_tables(spark, tmp_path):
    warehouse, staging = str(tmp_path / "w"), str(tmp_path / "s")
    first, second = date(2024, 5, 2), date(2024, 5, 3)
    late = "2024-05-02T23:30:00.5+00:00"
    loads = {
        first: [record("2024-05-02", late), record("2024-05-02", late, price=-1.0)],
        second: [record("2024-05-03", late), record("2024-05-03", "2024-05-03T08:00:00+00:00", sales_count=1)],
    }
    for day, lines in loads.items():
        (tmp_path / f"{day}").mkdir()
        (tmp_path / f"{day}" / "x.json").write_text("\n".join(lines))
        found = daily_job.run_day(spark, str(tmp_path / f"{day}"), warehouse, staging, SNAPSHOTS, day, day)
        again = daily_job.run_day(spark, str(tmp_path / f"{day}"), warehouse, staging, SNAPSHOTS, day, day)
        assert found["loaded"] == 2 and again["loaded"] == 0
        if day == first:
            assert {tuple(r) for r in found["quality"].collect()} == {("duplicates", 1, "warning"), ("nulls", 0, "ok")}
            assert tuple(found["stats"].first()) == (1, 1, 10.0, 4)

    def stored():
        columns = ["sale_date", "sale_timestamp", "sales_count"]
        return sorted(tuple(r) for r in spark.read.parquet(f"{warehouse}/cleaned_sales_data").select(columns).collect())

    raw = daily_job.raw_table(spark, warehouse, SNAPSHOTS)
    assert raw.count() == 4 and spark.read.parquet(f"{warehouse}/cleaned_sales_data").columns[-1] == "sale_date"
    plan = raw.where(F.col("ingestion_date") == F.lit(first))._jdf.queryExecution().executedPlan().toString()
    assert "ingestion_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert {p.name for p in (tmp_path / "w" / "archive").rglob("x.json")} == {"x.json"}

    before = stored()
    assert [r[2] for r in before] == [4, 4, 1]
    assert spark.read.parquet(f"{warehouse}/product_performance").first().total_sales == 9
    daily_job.run_day(spark, "", warehouse, staging, SNAPSHOTS, second, second, rerun=True)
    assert stored() == before
    with pytest.raises(ValueError):
        daily_job.run_day(spark, "", warehouse, staging, SNAPSHOTS, second, rerun=True)
