import json
from datetime import date, datetime, timedelta

import pytest

from pasarlens.streaming import alerts, ingest

MINUTE = 60
START = datetime(2024, 1, 1, 12, 0, 0)
RECORD = {"product_id": "a", "product_name": "n", "price": 2, "category": "c", "sales_count": 3}


def land(folder, name, records):
    folder.mkdir(exist_ok=True)
    document = {"metadata": {"ingestion_id": name, "record_count": len(records)}, "data": records}
    (folder / f"{name}.json").write_text(json.dumps(document, indent=2))


def test_ingest_takes_each_file_once(spark, tmp_path):
    raw, table, rejected, checkpoint = (str(tmp_path / n) for n in ("raw", "table", "rejected", "checkpoint"))

    def run():
        ingest.ingest(ingest.stream_envelopes(spark, raw), table, rejected, checkpoint, date(2024, 1, 1))

    land(tmp_path / "raw", "one", [RECORD, {"product_id": "b"}])
    run()
    land(tmp_path / "raw", "two", [RECORD, {**RECORD, "price": "much"}])
    (tmp_path / "raw" / "broken.json").write_text('{"metadata": {')
    run()
    run()
    rows = spark.read.parquet(table).collect()
    assert [(r.product_id, r.revenue) for r in rows] == [("a", 6.0), ("a", 6.0)]
    turned_away = spark.read.parquet(rejected).collect()
    assert sorted(r.reason for r in turned_away) == ["malformed number", "missing key", "unreadable file"]
    broken = next(r for r in turned_away if r.reason == "unreadable file")
    assert broken.file_path.endswith("broken.json") and broken.record == '{"metadata": {'


def test_ingest_archives_finished_files(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("table", "rejected", "checkpoint")]
    for name in ("one", "two"):
        land(tmp_path / "raw", name, [RECORD])
        stream = ingest.stream_envelopes(spark, str(tmp_path / "raw"), str(tmp_path / "archive"))
        ingest.ingest(stream, *paths, date(2024, 1, 1))
    assert spark.read.parquet(paths[0]).count() == 2
    archived = [p.name for p in (tmp_path / "archive").rglob("*.json")]
    assert "one.json" in archived


def test_validate(spark, tmp_path):
    land(tmp_path / "raw", "one", [RECORD, {"product_id": "b"}])
    (tmp_path / "raw" / "bad.json").write_text('{"metadata": {}}')
    results = str(tmp_path / "results")
    (tmp_path / "raw" / "null.json").write_text('{"metadata": null, "data": [{"product_id": "a", "price": 1}, null]}')
    (tmp_path / "raw" / "cut.json").write_text('{"metadata": {}, "data": [')
    ingest.validate(ingest.stream_documents(spark, str(tmp_path / "raw")), results, str(tmp_path / "checkpoint"))
    found = {
        r.file_path.rsplit("/", 1)[1]: (r.is_valid, r.valid_records, r.invalid_records)
        for r in spark.read.parquet(results).collect()
    }
    assert found == {
        "one.json": (True, 1, 1), "null.json": (True, 1, 1), "bad.json": (False, 0, 0), "cut.json": (False, 0, 0)
    }


def test_summary_of_a_touched_month_is_replaced(spark, tmp_path):
    raw, summary, checkpoint = (str(tmp_path / n) for n in ("raw", "summary", "checkpoint"))
    schema = "ingestion_date date, category string, price double, sales_count bigint, revenue double"
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 1)]
    batches = [
        [(days[0], "a", 1.0, 1, 1.0), (days[2], "a", 1.0, 5, 5.0), (None, "a", 2.0, 1, 2.0)],
        [(days[0], "b", 3.0, 9, 27.0), (None, "c", 2.0, 2, 4.0)],
    ]
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        ingest.refresh_daily_summary(stream, raw, summary, checkpoint, df.schema)
    found = {r.summary_date: (r.total_sales, r.total_quantity, r.top_category) for r in spark.read.parquet(summary).collect()}
    assert found == {days[0]: (28.0, 10, "b"), days[2]: (5.0, 5, "a"), None: (6.0, 3, "c")}


def test_append_new_keys_over_batches(spark, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for rows in ([("a", 1), ("a", 2)], [("a", 3), ("b", 4)], [("b", 5)]):
        df = spark.createDataFrame(rows, "id string, v bigint")
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        ingest.append_new_keys(stream, table, checkpoint, "id", df.schema)
    assert sorted((r.id, r.v) for r in spark.read.parquet(table).collect()) == [("a", 1), ("a", 2), ("b", 4)]


def metrics(spark, counts):
    """Minute buckets with the given error counts; None leaves the minute out."""
    rows = [
        (START + timedelta(minutes=i), START + timedelta(minutes=i + 1), n, n, 0.0)
        for i, n in enumerate(counts)
        if n is not None
    ]
    return spark.createDataFrame(rows, alerts.BUCKET_METRICS)


@pytest.mark.parametrize(
    ("counts", "ends"),
    [
        ([6, 7, 8, 9, 6], [5]),
        ([6, 7, 8, 9, 5, 6], []),
        ([6, 7, None, 8, 9, 6, 6], []),
        ([6] * 7, [5, 6, 7]),
    ],
)
def test_error_alert_must_hold(spark, counts, ends):
    found = alerts.error_alerts(metrics(spark, counts), MINUTE).collect()
    assert sorted(r.alert_at for r in found) == [START + timedelta(minutes=m) for m in ends]
    if counts == [6, 7, 8, 9, 6]:
        assert (found[0].min_errors, found[0].total_errors) == (6, 36)


def test_threshold_must_not_be_negative(spark):
    with pytest.raises(ValueError):
        alerts.error_alerts(metrics(spark, [1]), MINUTE, threshold=-1)


def test_stream_of_buckets_equals_batch(spark, tmp_path):
    rows = [(START + timedelta(seconds=20 * i), "ok" if i % 3 else "error", 0.5) for i in range(300)]
    schema = "ts timestamp, status string, cost double"
    for part in (rows[100:], rows[:100]):  # the oldest come last, and still count
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        found = alerts.stream_bucket_metrics(stream, str(tmp_path / "t"), str(tmp_path / "c"), MINUTE)
    batch = alerts.bucket_metrics(spark.createDataFrame(rows, schema), MINUTE)
    assert {tuple(r) for r in found.select(batch.columns).collect()} == {tuple(r) for r in batch.collect()}
    assert tuple(alerts.late_rows(spark, str(tmp_path / "t")).first()) == (300, 100)


def test_rates_and_costs(spark):
    rows = [(START, START + timedelta(days=1), 100, 11, 50.01), (START, START + timedelta(days=1), 100, 10, 50.0)]
    df = spark.createDataFrame(rows, alerts.BUCKET_METRICS)
    assert [r.errors for r in alerts.error_rate(df).collect()] == [11]
    assert [r.daily_cost for r in alerts.cost_alerts(df).collect()] == [50.01]
    assert alerts.execution_rate(df, 50).first().per_second == 2.0
