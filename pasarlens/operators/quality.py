"""Data-quality rules and reports. Reports warn; they never block a load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.operators.records import FILE_CHECK_KEYS, has_keys

CRITICAL_COLUMNS = ["product_id", "price", "category"]


def _day_slice(df: DataFrame, day: date | None) -> DataFrame:
    return df if day is None else df.where(F.col("ingestion_date") == F.lit(day))


def _as_rows(one_row: DataFrame, key_name: str, value_name: str, extra: str = "") -> DataFrame:
    """Turn the columns of a one-row result into rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) as ({key_name}, {value_name})")


def run_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count the rows that break each rule, all rules in one scan; a rule passes when none does."""
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return _as_rows(counts, "check_name", "bad_rows").withColumn("passed", F.col("bad_rows") == 0)


def negative_prices() -> dict[str, Column]:
    return {"negative_prices": F.col("price") < 0}


def null_product_ids() -> dict[str, Column]:
    return {"null_product_ids": F.col("product_id").isNull()}


def standard_rules() -> dict[str, Column]:
    return {**negative_prices(), **null_product_ids()}


def required_rules(schema: T.StructType) -> dict[str, Column]:
    """One rule per required column of a declared table: it must not be null."""
    return {f"null_{field.name}": F.col(field.name).isNull() for field in schema if not field.nullable}


def quality_score(rule_results: DataFrame) -> DataFrame:
    """Passed and total rules, whole percent, and the band: all, most (80 and up) or attention."""
    passed, total = F.count_if("passed"), F.count("*")
    scored = rule_results.agg(passed.alias("passed"), total.alias("total")).withColumn(
        "percent", F.expr("try_divide(passed * 100, total)").cast("bigint")
    )
    band = F.when(F.col("percent") == 100, "all").when(F.col("percent") >= 80, "most").otherwise("attention")
    return scored.withColumn("band", band)


def raw_duplicates(raw: DataFrame, day: date | None = None) -> DataFrame:
    """Number of (product, timestamp) groups with more than one row."""
    groups = _day_slice(raw, day).groupBy("product_id", "timestamp").agg(F.count("*").alias("copies"))
    return groups.agg(F.count_if(F.col("copies") > 1).alias("duplicate_count"))


def raw_nulls(raw: DataFrame, day: date | None = None) -> DataFrame:
    """Null counts of the critical columns and their total."""
    counts = [F.count_if(F.col(c).isNull()) for c in CRITICAL_COLUMNS]
    return _day_slice(raw, day).agg(
        *[n.alias(f"null_{c}") for n, c in zip(counts, CRITICAL_COLUMNS)],
        (counts[0] + counts[1] + counts[2]).alias("total_nulls"),
    )


def quality_report(raw: DataFrame, day: date | None = None) -> DataFrame:
    """Duplicates and nulls of a load as (metric, bad_rows, status) rows, from a single scan.

    Grouping by the duplicate key first keeps null counts exact: they are summed over the groups.
    """
    nulls = F.lit(0)
    for c in CRITICAL_COLUMNS:
        nulls = nulls + F.col(c).isNull().cast("int")
    groups = (
        _day_slice(raw, day)
        .groupBy("product_id", "timestamp")
        .agg(F.count("*").alias("copies"), F.sum(nulls).alias("nulls"))
    )
    totals = groups.agg(
        F.count_if(F.col("copies") > 1).alias("duplicates"),
        F.coalesce(F.sum("nulls"), F.lit(0)).cast("bigint").alias("nulls"),
    )
    status = F.when(F.col("bad_rows") > 0, "warning").otherwise("ok")
    return _as_rows(totals, "metric", "bad_rows").withColumn("status", status)


def _has_key(key: str) -> Column:
    """Whether a document's text is a JSON object with the key, whatever its value."""
    return F.coalesce(F.array_contains(F.json_object_keys("value"), key), F.lit(False))


def envelope_structure(documents: DataFrame) -> DataFrame:
    """Per landed file: is it JSON with both a metadata and a data key? Expects ``file_path`` and ``value``."""
    has_metadata, has_data = _has_key("metadata"), _has_key("data")
    return documents.select(
        "file_path",
        has_metadata.alias("has_metadata"),
        has_data.alias("has_data"),
        (has_metadata & has_data).alias("is_valid"),
    )


def file_validation(documents: DataFrame) -> DataFrame:
    """Per landed file: structure by the keys of its text, and how many records carry the checked keys.

    Expects ``file_path`` and ``value``. A file is one row with an array of records, so the counts need neither an
    explode nor a shuffle.
    """
    parsed = documents.select(
        "file_path",
        (_has_key("metadata") & _has_key("data")).alias("is_valid"),
        F.from_json("value", "data array<variant>")["data"].alias("data"),
    )
    good = F.size(F.filter("data", lambda record: has_keys(FILE_CHECK_KEYS, record)))
    return parsed.select(
        "file_path",
        "is_valid",
        F.coalesce(F.when(F.col("data").isNotNull(), good), F.lit(0)).cast("bigint").alias("valid_records"),
        F.coalesce(F.when(F.col("data").isNotNull(), F.size("data") - good), F.lit(0)).cast("bigint").alias("invalid_records"),
    )
