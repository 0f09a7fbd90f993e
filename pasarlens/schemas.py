"""Declared table schemas. Timestamps are instants; the session time zone, UTC, decides their day."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(spec: str) -> T.StructType:
    """Build a schema from ``name type`` pairs, without a session; a trailing ``!`` marks a required column."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


SALES = _schema(
    "transaction_id string!, product_id string, product_name string, category string, price double, "
    "discount_percent double, actual_price double, quantity bigint, total_amount double, seller_name string, "
    "seller_location string, sale_date date, sale_month string, day_of_week string, ingestion_date date"
)

REVIEWS = _schema(
    "review_id string!, review_text string, review_date date, product_id string, product_name string, "
    "product_category string, product_variant string, product_price double, product_url string, rating bigint, "
    "sold_count bigint, shop_id string, sentiment_label string, ingestion_date date"
)

SNAPSHOTS = _schema(
    "product_id string!, product_name string!, category string!, price double!, original_price double, "
    "discount_percent double, sales_count bigint, rating double, review_count bigint, stock bigint, "
    "seller_name string, seller_location string, timestamp timestamp!, ingestion_date date!"
)

CLEANED = _schema(
    "product_id string!, product_name string!, category string!, price double!, discount_price double, "
    "discount_percent double, sales_count bigint!, rating double, review_count bigint, stock_status string, "
    "seller_name string, seller_location string, sale_date date!, sale_timestamp timestamp!"
)

CATALOGUE = _schema(
    "product_id string, product_name string, category string, price double, original_price double, stock bigint, "
    "seller_name string, seller_location string, rating double, review_count bigint"
)

# One landed batch: a metadata object and the records. Records stay variants, which keep the difference between
# a missing key, a null and a quoted number without a second parse.
ENVELOPE = T.StructType(
    [
        T.StructField(
            "metadata",
            _schema("ingestion_id string, ingestion_timestamp string, record_count bigint, source string"),
        ),
        T.StructField("data", T.ArrayType(T.VariantType())),
    ]
)

