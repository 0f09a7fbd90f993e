from datetime import date

from pyspark.sql import functions as F

from pasarlens.operators import records as r

DAY = date(2024, 1, 31)
FULL = '{"product_id":"a","product_name":"n","price":1,"category":"c"}'


def ids(df):
    return [x[0] for x in df.select(F.try_variant_get("record", "$.product_id", "string")).collect()]


def test_required_keys_are_about_presence(json_records):
    rows = json_records(
        FULL,
        '{"product_id":null,"product_name":null,"price":null,"category":null}',
        '{"product_id":"","product_name":"","price":0,"category":""}',
        '{"product_id":"x","price":1,"category":"c"}',
    )
    assert ids(r.validate_required(rows)) == ["a", None, ""]
    assert [(x["reason"]) for x in r.quarantine(rows).collect()] == ["missing key"]


def test_numbers_and_bad_numbers(json_records):
    rows = json_records(
        '{"product_id":"text","price":"12.5","sales_count":"7"}',
        '{"product_id":"cut","price":3,"sales_count":12.9}',
        '{"product_id":"absent"}',
        '{"product_id":"null","price":null,"sales_count":null}',
        '{"product_id":"word","price":"abc"}',
        '{"product_id":"fraction text","price":1,"sales_count":"12.5"}',
    )
    out = r.coerce_types(rows).select(F.try_variant_get("record", "$.product_id", "string"), "price", "sales_count")
    assert [tuple(x) for x in out.collect()] == [
        ("text", 12.5, 7),
        ("cut", 3.0, 12),
        ("absent", 0.0, 0),
        ("null", 0.0, 0),
    ]


def test_normalize_defaults(json_records):
    rows = r.normalize_records(
        json_records(
            '{"product_id":7,"product_name":"\\t Kopi  Toraja \\n","price":"10","sales_count":3}',
            '{"original_price":5,"price":4,"category":null,"stock":"9"}',
            '{"rating":"good"}',
        ),
        DAY,
    ).collect()
    assert len(rows) == 2
    first, second = rows
    assert (first.product_id, first.product_name, first.category) == ("7", "Kopi  Toraja", "Unknown")
    assert (first.price, first.original_price, first.revenue) == (10.0, 10.0, 30.0)
    assert (first.ingestion_date, first.sale_date) == (DAY, DAY)
    assert (second.product_id, second.category, second.original_price, second.stock) == ("", "Unknown", 5.0, 9)
    assert second.revenue == 0.0


def test_every_record_is_either_loaded_or_quarantined(json_records):
    rows = json_records(FULL, '{"price":"x"}', FULL.replace(":1", ':"x"'), FULL.replace(":1", ":1,\"stock\":\"1.5\""))
    loaded = r.normalize_records(r.validate_required(rows), DAY).count()
    assert (loaded, r.quarantine(rows).count()) == (1, 3)


def test_numbers_that_are_not_finite_are_turned_away(spark):
    rows = [("a", 1.0, 2.0), ("nan", float("nan"), 1.0), ("inf", float("inf"), 1.0), ("rated", 1.0, float("-inf")), ("none", None, None)]
    df = spark.createDataFrame(rows, "product_id string, price double, rating double")
    fields = [F.col("product_id"), F.lit("n").alias("product_name"), F.col("price"), F.lit("c").alias("category"), F.col("rating")]
    records = df.select(F.to_variant_object(F.struct(*fields)).alias("record"))
    assert sorted(x.product_id for x in r.normalize_records(records, DAY).collect()) == ["a", "none"]
    turned_away = r.quarantine(records).collect()
    assert [x.reason for x in turned_away] == ["malformed number"] * 3
    assert sorted(ids(r.coerce_types(records))) == ["a", "none", "rated"]
