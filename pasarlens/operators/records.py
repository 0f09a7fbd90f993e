"""Raw JSON records (one ``record`` variant column) to typed rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import is_finite, strip

# The keys a raw record must carry to be ingested, and to count as valid in a file check.
REQUIRED_KEYS = ["product_id", "product_name", "price", "category"]
FILE_CHECK_KEYS = ["product_id", "price"]

# Field, type and default of a normalised record.
TEXT_FIELDS = {
    "product_id": "",
    "product_name": "",
    "category": "Unknown",
    "seller_name": "",
    "seller_location": "",
}
NUMBER_FIELDS = {
    "price": "double",
    "original_price": "double",
    "discount_percent": "bigint",
    "sales_count": "bigint",
    "rating": "double",
    "review_count": "bigint",
    "stock": "bigint",
}


def to_records(df: DataFrame, *keep: str) -> DataFrame:
    """Turn rows into JSON records. Null columns become missing keys; ``keep`` columns stay beside the record.

    Exploding a one-element array keeps the parse in one place: as a plain column the optimizer would copy it
    into every later filter on the record.
    """
    body = [c for c in df.columns if c not in keep]
    parsed = F.parse_json(F.to_json(F.struct(*body)))
    return df.select(*keep, F.explode(F.array(parsed)).alias("record"))


def has_keys(keys: list[str], record: Column | str = "record") -> Column:
    """True when the record carries every key, even with a null value.

    A key with a value is settled by reading it as text; only otherwise is the raw element copied out.
    """
    present = F.lit(True)
    for key in keys:
        as_text = F.try_variant_get(record, f"$.{key}", "string")
        present = present & (as_text.isNotNull() | F.variant_get(record, f"$.{key}", "variant").isNotNull())
    return present


def _is_malformed(key: str, typed: Column) -> Column:
    """A value that is there but cannot be read as the type: a word for a price, '12.5' for a count."""
    raw = F.variant_get("record", f"$.{key}", "variant")
    return typed.isNull() & raw.isNotNull() & ~F.is_variant_null(raw)


def _typed(records: DataFrame, fields: dict[str, str], *keep: str) -> DataFrame:
    """``keep``, ``record`` and the typed fields; unreadable values are null.

    The record is read once, as a struct. Expanding that struct with ``inline`` and not as plain columns stops the
    optimizer from repeating the read in every later filter and expression.
    """
    struct_type = "struct<" + ", ".join(f"{key}: {kind}" for key, kind in fields.items()) + ">"
    return records.select(*keep, "record", F.inline(F.array(F.try_variant_get("record", "$", struct_type))))


def _any_malformed(keys: Iterable[str]) -> Column:
    """Over the output of ``_typed``; a double that is not finite is no number either."""
    bad = F.lit(False)
    for key in keys:
        bad = bad | _is_malformed(key, F.col(key))
        if NUMBER_FIELDS[key] == "double":
            bad = bad | F.coalesce(~is_finite(key), F.lit(False))
    return bad


def validate_required(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keep the records that carry every required key."""
    return records.where(has_keys(keys or REQUIRED_KEYS))


def quarantine(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The records that loading turns away, with the reason: a missing key or a number that cannot be read."""
    typed = _typed(records, NUMBER_FIELDS, *[c for c in records.columns if c != "record"])
    reason = F.when(~has_keys(keys or REQUIRED_KEYS), "missing key").when(
        _any_malformed(NUMBER_FIELDS), "malformed number"
    )
    return typed.select(*records.columns, reason.alias("reason")).where(F.col("reason").isNotNull())


def judged_records(records: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the typed fields, whether a record is ``accepted``, and of one that loading turns away the ``reason`` and the text: both
    outcomes of ``validate_required`` with ``normalize_records`` and of ``quarantine`` in one pass."""
    typed = _typed(records, {**{key: "string" for key in TEXT_FIELDS}, **NUMBER_FIELDS}, *keep)
    complete, malformed = has_keys(REQUIRED_KEYS), _any_malformed(NUMBER_FIELDS)
    reason = F.when(~complete, "missing key").when(malformed, "malformed number")
    judged = typed.select("*", F.inline(F.array(F.struct(reason.alias("reason"), F.coalesce(complete & ~malformed, F.lit(False)).alias("accepted")))))
    text = F.when(F.col("reason").isNotNull(), F.to_json("record"))
    return judged.withColumn("text", text).drop("record")


def coerce_types(records: DataFrame) -> DataFrame:
    """Add typed ``price`` and ``sales_count`` (0 when absent); rows with unreadable numbers are dropped."""
    fields = {key: NUMBER_FIELDS[key] for key in ("price", "sales_count")}
    typed = _typed(records, fields, *[c for c in records.columns if c != "record"])
    return typed.where(~_any_malformed(fields)).fillna(0, list(fields))


def normalize_records(records: DataFrame, as_of: date, *keep: str) -> DataFrame:
    """Typed, defaulted rows with revenue; both dates are the load day. Unreadable rows are left to quarantine."""
    fields = {**{key: "string" for key in TEXT_FIELDS}, **NUMBER_FIELDS}
    return defaulted(_typed(records, fields, *keep).where(~_any_malformed(NUMBER_FIELDS)), as_of, *keep)


def defaulted(rows: DataFrame, as_of: date, *keep: str) -> DataFrame:
    """Typed rows with defaults for what is missing, revenue and the load day."""
    price, quantity = F.coalesce("price", F.lit(0.0)), F.coalesce("sales_count", F.lit(0))

    def text(key: str) -> Column:
        return F.coalesce(key, F.lit(TEXT_FIELDS[key])).alias(key)

    def number(key: str) -> Column:
        missing = price if key == "original_price" else F.lit(0)
        return F.coalesce(F.col(key), missing.cast(NUMBER_FIELDS[key])).alias(key)

    return rows.select(
        *keep,
        text("product_id"),
        strip(text("product_name")).alias("product_name"),
        text("category"),
        *[number(key) for key in NUMBER_FIELDS],
        text("seller_name"),
        text("seller_location"),
        F.lit(as_of).alias("ingestion_date"),
        F.lit(as_of).alias("sale_date"),
        (price * quantity).alias("revenue"),
    )
