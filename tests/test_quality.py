from pyspark.sql import functions as F

from pasarlens.operators import quality as q
from pasarlens.plans import review_reports
from pasarlens.sources import landing


def test_rules_and_score(spark):
    df = spark.createDataFrame([("a", 1.0), (None, -1.0), ("c", None)], "product_id string, price double")
    result = q.run_rules(df, {**q.standard_rules(), "always": F.lit(False), "x": F.lit(False), "y": F.lit(False)})
    found = {r.check_name: (r.bad_rows, r.passed) for r in result.collect()}
    assert found["negative_prices"] == (1, False) and found["always"] == (0, True)
    assert tuple(q.quality_score(result).first()) == (3, 5, 60, "attention")
    assert q.quality_score(result.where("passed")).first().band == "all"
    good = q.run_rules(df, {"p": F.lit(False), "q": F.lit(False), "r": F.lit(False), "s": F.lit(False)})
    mostly = good.unionByName(result.where("check_name = 'negative_prices'"))
    assert tuple(q.quality_score(mostly).first()) == (4, 5, 80, "most")


def test_report_counts_duplicates_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "t1", 1.0, "c"), ("a", "t1", None, "c"), ("b", "t1", 1.0, None), (None, "t2", None, None)],
        "product_id string, timestamp string, price double, category string",
    )
    assert q.raw_duplicates(df).first()[0] == 1
    assert tuple(q.raw_nulls(df).first()) == (1, 2, 2, 5)
    assert {tuple(r) for r in q.quality_report(df).collect()} == {("duplicates", 1, "warning"), ("nulls", 5, "warning")}
    assert {r.status for r in q.quality_report(df.limit(0)).collect()} == {"ok"}


def test_landed_files(spark, tmp_path):
    files = {
        "good.json": '{\n "metadata": {"ingestion_id": "i"},\n "data": [{"product_id": null, "price": 1}, {"price": 2}]\n}',
        "no_data.json": '{"metadata": {}}',
        "no_metadata.json": '{"data": []}',
        "broken.json": '{"metadata": {',
        "null_metadata.json": '{"metadata": null, "data": []}',
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    structure = q.envelope_structure(landing.read_documents(spark, str(tmp_path)))
    valid = {r.file_path.rsplit("/", 1)[1] for r in structure.collect() if r.is_valid}
    assert valid == {"good.json", "null_metadata.json"}
    documents = landing.read_documents(spark, str(tmp_path))
    counts = {
        r.file_path.rsplit("/", 1)[1]: (r.is_valid, r.valid_records, r.invalid_records)
        for r in q.file_validation(documents).collect()
    }
    assert counts["good.json"] == (True, 1, 1)
    assert counts["no_data.json"] == counts["broken.json"] == (False, 0, 0)
    envelopes = landing.read_envelopes(spark, str(tmp_path))
    assert landing.envelope_records(envelopes).count() == 2
    turned_away = {r.file_path.rsplit("/", 1)[1]: r.reason for r in landing.unreadable_files(envelopes).collect()}
    assert turned_away == {"broken.json": "unreadable file", "no_data.json": "no data"}


def test_profile_counts_rows_without_label_or_category(spark):
    df = spark.createDataFrame(
        [("c", "Positive", 5), ("c", None, 3), (None, "Negative", None), ("d", "Positive", 4)],
        "product_category string, sentiment_label string, rating bigint",
    )
    rows = {(r.metric, r.item): r.value for r in review_reports.review_profile(df, top=1).collect()}
    assert rows == {
        ("total_records", ""): 4.0,
        ("categories", ""): 2.0,
        ("avg_rating", ""): 4.0,
        ("top_category", "c"): 2.0,
        ("label_count", "Positive"): 2.0,
        ("label_percent", "Positive"): 50.0,
        ("label_count", "Negative"): 1.0,
        ("label_percent", "Negative"): 25.0,
    }


def test_shares_add_up(spark):
    df = spark.createDataFrame(
        [("c", label, 1) for label in ["Positive"] * 3 + ["Negative"] * 2 + ["Neutral"]],
        "product_category string, sentiment_label string, rating bigint",
    )
    total = sum(r.percentage for r in review_reports.sentiment_share(df).collect())
    assert abs(total - 100) < 0.05
