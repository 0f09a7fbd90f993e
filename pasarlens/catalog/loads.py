"""Readers, writers and key-based loads. Each query stores its input in a fresh folder first, then loads it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.catalog import datasets as d
from pasarlens.catalog.datasets import AS_OF, EVENTS_AS_OF, sql_sum
from pasarlens.catalog.snapshots import PERFORMANCE_SQL
from pasarlens.operators import keys as k
from pasarlens.operators.cleaning import coerce_reviews
from pasarlens.operators.frequent import frequent_duplicates
from pasarlens.operators.quality import envelope_structure, file_validation, required_rules, run_rules
from pasarlens.operators.records import normalize_records
from pasarlens.plans import daily_job
from pasarlens.plans import snapshot_reports as r
from pasarlens.plans.sales_reports import category_revenue
from pasarlens.schemas import REVIEWS, SNAPSHOTS
from pasarlens.session import fresh_path
from pasarlens.sources import clustered, delimited, landing, tables

KEY = "transaction_id"
TIES = ("sale_date", "product_id", "seller_name", "total_amount")
CLUSTER = ("category", "seller_location")
CHANGED = ("quantity", "total_amount", "sale_date", "ingestion_date")
FIRST_LOAD, SECOND_LOAD = datetime(2001, 7, 31, 2, 0, 0), datetime(2001, 8, 1, 2, 0, 0)


def _dedupe(keep):
    return lambda spark, sf: k.remove_duplicates(d.sales(spark, sf), KEY, keep, tie_break=TIES)


def _merge_sides(spark, sf):
    """Stored rows and a newer batch, both with unique keys. Month and weekday, which the day decides, are added to the rows that stay."""
    sales = d.sales_rows(spark, sf)
    sides = (k.remove_duplicates(side, KEY, "last", tie_break=TIES) for side in (d.history(sales), d.arriving(sales)))
    return tuple(map(d.with_sale_calendar, sides))


def upsert(spark, sf):
    target, source = _merge_sides(spark, sf)
    return k.upsert(target, source, KEY, CHANGED)


def upsert_stats(spark, sf):
    return k.upsert_stats(*_merge_sides(spark, sf), KEY)


def upsert_partitioned(spark, sf):
    """The merge on a stored table, month by month; the last month before the split is touched by moved rows."""
    path = fresh_path(spark, "sales")
    target, source = _merge_sides(spark, sf)
    month = F.trunc("sale_date", "month").alias("month")
    tables.replace_table(target.select("*", month), path, "month")
    batch = source.select("*", month)
    tables.upsert_table(spark, path, fresh_path(spark, "staging"), batch, KEY, (*CHANGED, "month"), "month")
    return spark.read.parquet(path).drop("month")


def rewrite_without_duplicates(spark, sf):
    """``remove_duplicates`` stored back into the table it read."""
    path = fresh_path(spark, "sales")
    tables.replace_table(d.sales(spark, sf), path)
    tables.rewrite_table(
        spark, path, fresh_path(spark, "staging"), lambda t: k.remove_duplicates(t, KEY, "first", tie_break=TIES)
    )
    return spark.read.parquet(path).select(KEY, "sale_date", "product_id", "total_amount")


def envelope_folder(spark, sf):
    """Snapshots landed as batch documents; missing ids and prices are missing keys in the records."""
    path = fresh_path(spark, "landing")
    landing.write_envelopes(d.snapshots(spark, sf).drop("ingestion_date"), path, FIRST_LOAD, "snapshots")
    return path


def envelope_records(spark, sf):
    records = landing.envelope_records(landing.read_envelopes(spark, envelope_folder(spark, sf)))
    return normalize_records(records, AS_OF, "source").select(
        "source", "product_id", "product_name", "category", "price", "sales_count", "rating", "stock"
    )


def structure(spark, sf):
    files = envelope_structure(landing.read_documents(spark, envelope_folder(spark, sf)))
    return files.groupBy("has_metadata", "has_data", "is_valid").agg(F.count("*").alias("files"))


#: The kinds of documents that structure checks must tell apart, in the order of their numbers.
DOCUMENT_KINDS = ["whole", "bare", "null", "cut", "text"]


def structure_flags(spark, sf):
    """Every snapshot landed as a document of its own, some of them damaged: without data, with a null value, cut short, and no JSON."""
    path = fresh_path(spark, "landing")
    record = F.struct(*[c for c in d.snapshots(spark, sf).columns if c != "ingestion_date"])
    metadata = F.struct(F.lit("snapshots").alias("source"), F.lit(1).alias("record_count"))
    whole = F.to_json(F.struct(metadata.alias("metadata"), F.array(record).alias("data")))
    without = F.struct(F.lit(None).cast("string").alias("metadata"), F.array(record).alias("data"))
    number = F.col("stock") % len(DOCUMENT_KINDS)
    value = (
        F.when(number == 0, whole)
        .when(number == 1, F.to_json(F.struct(metadata.alias("metadata"))))
        .when(number == 2, F.to_json(without, {"ignoreNullFields": "false"}))
        .when(number == 3, F.substring(whole, F.lit(1), F.length(whole) - 2))
        .otherwise(F.col("product_name"))
    )
    kind = F.element_at(F.array(*map(F.lit, DOCUMENT_KINDS)), (number + 1).cast("int"))
    d.snapshots(spark, sf).select(value.alias("value"), kind.alias("kind")).write.partitionBy("kind").text(path)
    landed = spark.read.option("recursiveFileLookup", True).text(path)
    found = envelope_structure(landed.select(F.col("_metadata.file_path").alias("file_path"), "value"))
    kind = F.regexp_extract("file_path", r"kind=([a-z]+)", 1)
    return found.groupBy(kind.alias("kind"), "has_metadata", "has_data", "is_valid").agg(F.count("*").alias("files"))


def validate_files(spark, sf):
    files = file_validation(landing.read_documents(spark, envelope_folder(spark, sf)))
    return files.groupBy("is_valid").agg(
        F.sum("valid_records").alias("valid_records"), F.sum("invalid_records").alias("invalid_records")
    )


def load_ndjson(spark, sf):
    """Two loads into one table; the second brings two columns the table did not have."""
    first, second, table = (fresh_path(spark, name) for name in ("first", "second", "table"))
    sales = d.sales(spark, sf)
    narrow = [KEY, "product_id", "quantity", "total_amount"]
    wide = [*narrow, "seller_name", "sale_month"]
    d.history(sales).select(narrow).write.json(first)
    d.arriving(sales).select(wide).write.json(second)
    for source, columns in ((first, narrow), (second, wide)):
        schema = T.StructType([sales.schema[c] for c in columns])
        landing.load_ndjson(spark, source, table, fresh_path(spark, "staging"), schema)
    return landing.read_growing_table(spark, table)


def schema_growing_append(spark, sf):
    sales = d.sales(spark, sf).select(KEY, "product_id", "quantity", "seller_name", "sale_month", "sale_date")
    table = d.history(sales).drop("seller_name", "sale_month")
    return landing.schema_growing_append(table, d.arriving(sales))


def load_csv_replace(spark, sf):
    source, table = fresh_path(spark, "transactions.csv"), fresh_path(spark, "raw_sales")
    delimited.write_csv(d.sales(spark, sf).drop("ingestion_date"), source)
    return delimited.load_csv(spark, source, table)


def load_reviews(spark, sf):
    """Review text with line breaks, commas and quotes, loaded as text and then coerced."""
    source, table = fresh_path(spark, "reviews.csv"), fresh_path(spark, "reviews")
    text = F.concat("review_text", F.lit(':\n"'), "product_name", F.lit('", ok'))
    reviews = d.reviews(spark, sf).withColumn("review_text", text)
    delimited.write_csv(reviews, source)
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in reviews.columns])
    return coerce_reviews(delimited.load_csv(spark, source, table, as_text, multi_line=True), EVENTS_AS_OF)


def save_reviews_csv(spark, sf):
    path = fresh_path(spark, "processed.csv")
    reviews = d.reviews(spark, sf)
    delimited.write_csv(reviews, path)
    return delimited.read_csv(spark, path, reviews.schema)


def catalogue_scan(spark, sf):
    path = fresh_path(spark, "products.csv")
    delimited.write_csv(d.catalogue(spark, sf), path)
    return delimited.read_catalogue(spark, path)


def _two_batches(spark, sf, path):
    sales = d.sales(spark, sf)
    landing.write_landing(d.history(sales), path, FIRST_LOAD, "history")
    landing.write_landing(d.arriving(sales), path, SECOND_LOAD, "arriving")
    return sales.schema


def landing_batches(spark, sf):
    path = fresh_path(spark, "raw")
    return landing.landing_batches(spark, path, _two_batches(spark, sf, path))


def new_files(spark, sf):
    path = fresh_path(spark, "raw")
    _two_batches(spark, sf, path)
    return landing.new_files(spark, path, date(2001, 8, 1))


def new_files_gate(spark, sf):
    """Whether there are files since a day: one day before all of them, one after."""
    path = fresh_path(spark, "raw")
    _two_batches(spark, sf, path)
    days = [date(2001, 8, 1), date(2999, 1, 1)]
    counts = [
        landing.new_files(spark, path, day).agg(F.lit(day).alias("since"), (F.count("*") > 0).alias("any_new")) for day in days
    ]
    return counts[0].unionByName(counts[1])


def append_load(spark, sf):
    path, sales = fresh_path(spark, "sales"), d.sales(spark, sf)
    for part in (d.history(sales), d.arriving(sales)):
        tables.append_table(part.drop("ingestion_date"), path)
    return category_revenue(spark.read.parquet(path))


def replace_load(spark, sf):
    path, sales = fresh_path(spark, "sales"), d.sales(spark, sf)
    for part in (d.history(sales), d.arriving(sales)):
        tables.replace_table(part, path)
    return category_revenue(spark.read.parquet(path))


def _stored_by_day(spark, sf):
    path = fresh_path(spark, "sales")
    tables.replace_table(d.sales(spark, sf), path, "sale_date", CLUSTER)
    return path


def partition_pruned_scan(spark, sf):
    """A month of a table stored by day; the date filter becomes a partition filter."""
    stored = spark.read.parquet(_stored_by_day(spark, sf))
    return category_revenue(tables.unexpired(stored, "sale_date", 30, AS_OF).where(F.col("sale_date") <= F.lit(AS_OF)))


def expire_partitions(spark, sf):
    path = _stored_by_day(spark, sf)
    tables.expire_partitions(spark, path, "sale_date", 365, AS_OF)
    left = spark.read.parquet(path)
    return left.groupBy("sale_month").agg(F.count("*").alias("rows"), F.countDistinct("sale_date").alias("days"))


def backup_export(spark, sf):
    cleaned = tables.stored(d.cleaned(spark, sf), "cleaned")
    live = {
        "raw_sales_data": d.snapshots(spark, sf),
        "cleaned_sales_data": cleaned,
        "daily_summary": r.daily_category_summary(cleaned, AS_OF),
        "product_performance": r.product_performance(cleaned, AS_OF),
    }
    root, stamp = fresh_path(spark, "backup"), f"{SECOND_LOAD:%Y%m%d_%H%M%S}"
    rows = tables.backup_tables(live, root, stamp)
    return tables.backup_report(spark, rows, {name: df.schema for name, df in live.items()}, root, stamp)


RUN_DAY = date(2001, 7, 20)


def _run_day(spark, sf, times=1, day=RUN_DAY):
    """The daily run over all landed snapshots, cleaning one ingestion day or all; returns the warehouse folder."""
    landed, warehouse, staging = (fresh_path(spark, n) for n in ("landed", "warehouse", "staging"))
    snapshots = d.snapshots(spark, sf)
    tables.write_json(snapshots, landed)
    for _ in range(times):
        daily_job.run_day(spark, landed, warehouse, staging, SNAPSHOTS, AS_OF, day)
    return warehouse


def run_day(spark, sf):
    return spark.read.parquet(f"{_run_day(spark, sf)}/product_performance")


def run_all_days(spark, sf):
    return spark.read.parquet(f"{_run_day(spark, sf, day=None)}/product_performance")


def run_day_quality(spark, sf):
    return spark.read.parquet(f"{_run_day(spark, sf)}/quality_report").drop("ingestion_date")


def run_day_twice(spark, sf):
    """Rows of the tables after a second run over the same landing folder."""
    warehouse = _run_day(spark, sf, times=2)
    names = ("raw_sales_data", "cleaned_sales_data")
    counts = [
        spark.read.parquet(f"{warehouse}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        for name in names
    ]
    return counts[0].unionByName(counts[1])


def refresh_reports(spark, sf):
    """Both stored summaries, as (table, rows, total)."""
    warehouse = fresh_path(spark, "warehouse")
    daily_job.refresh_reports(d.sales(spark, sf), d.reviews(spark, sf), warehouse, d.CREATED_AT)
    daily, sentiment = (spark.read.parquet(f"{warehouse}/{t}") for t in ("sales_daily_summary", "sentiment_summary"))
    return daily.agg(
        F.lit("sales_daily_summary").alias("table_name"),
        F.count("*").alias("rows"),
        F.sum("total_transactions").alias("total"),
    ).unionByName(
        sentiment.agg(
            F.lit("sentiment_summary").alias("table_name"),
            F.count("*").alias("rows"),
            F.sum("review_count").alias("total"),
        )
    )


#: A seller of the given tables, which is the second clustering column.
ONE_SELLER = "Supplier#000000003"


def clustered_sales(spark, sf):
    """One seller's sales, read from a table clustered by category and seller."""
    path = fresh_path(spark, "clustered")
    clustered.write_clustered(d.sales(spark, sf), path, ["category", "seller_name"], 32)
    return clustered.read_clustered(spark, path, {"seller_name": ONE_SELLER})


QUERIES = {
    "clustered_sales": clustered_sales,
    "conform_reviews": lambda spark, sf: tables.conform(d.reviews(spark, sf), REVIEWS),
    "required_columns": lambda spark, sf: run_rules(d.snapshots(spark, sf), required_rules(SNAPSHOTS)),
    "run_day": run_day,
    "run_all_days": run_all_days,
    "run_day_quality": run_day_quality,
    "run_day_twice": run_day_twice,
    "new_files_gate": new_files_gate,
    "refresh_reports": refresh_reports,
    "append_new": lambda spark, sf: k.append_new(d.sales(spark, sf), d.history(d.sales(spark, sf)), KEY),
    "append_new_stats": lambda spark, sf: k.append_new_stats(d.sales(spark, sf), d.history(d.sales(spark, sf)), KEY),
    "upsert": upsert,
    "upsert_stats": upsert_stats,
    "upsert_partitioned": upsert_partitioned,
    "dedupe_first": _dedupe("first"),
    "dedupe_last": _dedupe("last"),
    "rewrite_without_duplicates": rewrite_without_duplicates,
    "frequent_products": lambda spark, sf: frequent_duplicates(d.snapshots(spark, sf), "product_id", 50),
    "frequent_orders": lambda spark, sf: frequent_duplicates(d.table(spark, sf, "lineitem"), "l_orderkey"),
    "check_duplicates": lambda spark, sf: k.check_duplicates(d.sales(spark, sf), KEY),
    "envelope_records": envelope_records,
    "envelope_structure": structure,
    "structure_flags": structure_flags,
    "file_validation": validate_files,
    "load_ndjson": load_ndjson,
    "schema_growing_append": schema_growing_append,
    "load_csv_replace": load_csv_replace,
    "load_reviews": load_reviews,
    "save_reviews_csv": save_reviews_csv,
    "catalogue_scan": catalogue_scan,
    "landing_batches": landing_batches,
    "new_files": new_files,
    "append_load": append_load,
    "replace_load": replace_load,
    "partition_pruned_scan": partition_pruned_scan,
    "expire_partitions": expire_partitions,
    "backup_export": backup_export,
}

_DAY_SQL = d.CLEANED_SQL.replace("WHERE price > 0", f"WHERE ingestion_date = DATE '{RUN_DAY}' AND price > 0")
_SPLIT = "DATE '2000-01-01'"
_REST = (
    "product_name, category, price, discount_percent, actual_price, quantity, seller_location, sale_month, day_of_week"
)


def _deduped(where: str, direction: str) -> str:
    nulls = "FIRST" if direction == "ASC" else "LAST"
    return f"""SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_date {direction} NULLS {nulls},
                                 sale_date, product_id, seller_name, total_amount, {_REST}) AS place
    FROM sales WHERE {where}) WHERE place = 1"""


_SIDES = f"""
target AS ({_deduped(f"sale_date < {_SPLIT}", "DESC")}),
source AS ({_deduped(f"sale_date >= {_SPLIT}", "DESC")})"""

_MERGED = f"""
WITH {d.SALES_SQL}, {_SIDES}
SELECT t.* REPLACE (coalesce(s.quantity, t.quantity) AS quantity, coalesce(s.total_amount, t.total_amount)
                    AS total_amount, coalesce(s.sale_date, t.sale_date) AS sale_date,
                    coalesce(s.ingestion_date, t.ingestion_date) AS ingestion_date)
FROM target t LEFT JOIN source s ON t.transaction_id = s.transaction_id
UNION ALL BY NAME
SELECT * FROM source WHERE transaction_id NOT IN (SELECT transaction_id FROM target)"""

_REVENUE = f"category, count(*) AS transactions, {sql_sum('total_amount')} AS revenue FROM sales"
_CSV_COLUMNS = "* EXCLUDE (ingestion_date)"

ORACLE = {
    "clustered_sales": f"""
WITH {d.SALES_SQL} SELECT * FROM sales WHERE seller_name = '{ONE_SELLER}'""",
    "conform_reviews": f"""
WITH {d.REVIEWS_SQL}
SELECT *, CAST(NULL AS VARCHAR) AS product_variant, CAST(NULL AS VARCHAR) AS product_url,
       CAST(NULL AS DATE) AS ingestion_date
FROM reviews""",
    "required_columns": f"WITH {d.SNAPSHOTS_SQL}\n"
    + "\nUNION ALL\n".join(
        f"""SELECT 'null_{c}' AS check_name, count(*) FILTER (WHERE "{c}" IS NULL) AS bad_rows,
       count(*) FILTER (WHERE "{c}" IS NULL) = 0 AS passed FROM snapshots"""
        for c in ("product_id", "product_name", "category", "price", "timestamp", "ingestion_date")
    ),
    "run_day": f"WITH {_DAY_SQL}, {PERFORMANCE_SQL} SELECT * FROM performance",
    "run_all_days": f"WITH {d.CLEANED_SQL}, {PERFORMANCE_SQL} SELECT * FROM performance",
    "run_day_quality": f"""
WITH {d.SNAPSHOTS_SQL},
rows_of_day AS (SELECT * FROM snapshots WHERE ingestion_date = DATE '{RUN_DAY}'),
counts AS (
  SELECT (SELECT count(*) FROM (SELECT 1 FROM rows_of_day GROUP BY product_id, "timestamp" HAVING count(*) > 1)) AS duplicates,
         (SELECT count(*) FILTER (WHERE product_id IS NULL) + count(*) FILTER (WHERE price IS NULL)
                 + count(*) FILTER (WHERE category IS NULL) FROM rows_of_day) AS nulls
)
SELECT 'duplicates' AS metric, duplicates AS bad_rows, CASE WHEN duplicates > 0 THEN 'warning' ELSE 'ok' END AS status FROM counts
UNION ALL SELECT 'nulls', nulls, CASE WHEN nulls > 0 THEN 'warning' ELSE 'ok' END FROM counts""",
    "run_day_twice": f"""
WITH {_DAY_SQL}
SELECT 'raw_sales_data' AS table_name, count(*) AS "rows" FROM snapshots
UNION ALL SELECT 'cleaned_sales_data', count(*) FROM cleaned""",
    "new_files_gate": """
SELECT DATE '2001-08-01' AS since, count(*) > 0 AS any_new FROM lineitem
UNION ALL SELECT DATE '2999-01-01', false""",
    "refresh_reports": f"""
WITH {d.SALES_SQL}, {d.REVIEWS_SQL}
SELECT 'sales_daily_summary' AS table_name, count(DISTINCT sale_date) AS "rows", count(*) AS total FROM sales
UNION ALL
SELECT 'sentiment_summary', count(DISTINCT (product_category, sentiment_label)), count(*) FROM reviews""",
    "append_new": f"""
WITH {d.SALES_SQL}
SELECT * FROM sales b
WHERE NOT EXISTS (SELECT 1 FROM sales t WHERE t.sale_date < {_SPLIT} AND t.transaction_id = b.transaction_id)""",
    "append_new_stats": f"""
WITH {d.SALES_SQL},
known AS (SELECT DISTINCT transaction_id FROM sales WHERE sale_date < {_SPLIT})
SELECT count(*) AS total_input, count(k.transaction_id) AS duplicates_skipped,
       count(*) - count(k.transaction_id) AS new_records, 'success' AS status
FROM sales s LEFT JOIN known k ON s.transaction_id = k.transaction_id""",
    "upsert": _MERGED,
    "upsert_partitioned": _MERGED,
    "upsert_stats": f"""
WITH {d.SALES_SQL}, {_SIDES},
counts AS (
  SELECT (SELECT count(*) FROM target WHERE transaction_id IN (SELECT transaction_id FROM source)) AS rows_updated,
         (SELECT count(*) FROM source WHERE transaction_id NOT IN (SELECT transaction_id FROM target))
           AS rows_inserted
)
SELECT *, rows_updated + rows_inserted AS rows_affected FROM counts""",
    "dedupe_first": f"WITH {d.SALES_SQL} {_deduped('true', 'ASC')}",
    "dedupe_last": f"WITH {d.SALES_SQL} {_deduped('true', 'DESC')}",
    "rewrite_without_duplicates": f"""
WITH {d.SALES_SQL}
SELECT transaction_id, sale_date, product_id, total_amount FROM ({_deduped('true', 'ASC')})""",
    "frequent_products": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT product_id, count(*) AS "count" FROM snapshots GROUP BY product_id HAVING count(*) > 1
ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 50""",
    "frequent_orders": """
SELECT l_orderkey, count(*) AS "count" FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 100""",
    "check_duplicates": f"""
WITH {d.SALES_SQL}
SELECT transaction_id, count(*) AS "count" FROM sales GROUP BY transaction_id HAVING count(*) > 1
ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 100""",
    "envelope_records": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT 'snapshots' AS source, coalesce(product_id, '') AS product_id, product_name, category,
       coalesce(price, 0) AS price, sales_count, rating, stock
FROM snapshots""",
    "structure_flags": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT kind, has_metadata, has_data, has_metadata AND has_data AS is_valid, count(*) AS files
FROM snapshots
JOIN (VALUES (0, 'whole', true, true), (1, 'bare', true, false), (2, 'null', true, true), (3, 'cut', false, false),
             (4, 'text', false, false)) t(number, kind, has_metadata, has_data) ON stock % 5 = number
GROUP BY ALL""",
    "file_validation": f"""
WITH {d.SNAPSHOTS_SQL},
counts AS (
  SELECT count(*) FILTER (WHERE product_id IS NOT NULL AND price IS NOT NULL) AS valid_records, count(*) AS total
  FROM snapshots
)
SELECT true AS is_valid, valid_records, total - valid_records AS invalid_records FROM counts""",
    "load_ndjson": f"""
WITH {d.SALES_SQL}
SELECT transaction_id, product_id, quantity, total_amount,
       CASE WHEN sale_date >= {_SPLIT} THEN seller_name END AS seller_name,
       CASE WHEN sale_date >= {_SPLIT} THEN sale_month END AS sale_month
FROM sales""",
    "schema_growing_append": f"""
WITH {d.SALES_SQL}
SELECT transaction_id, product_id, quantity, sale_date,
       CASE WHEN sale_date >= {_SPLIT} THEN seller_name END AS seller_name,
       CASE WHEN sale_date >= {_SPLIT} THEN sale_month END AS sale_month
FROM sales""",
    "load_csv_replace": f"WITH {d.SALES_SQL} SELECT {_CSV_COLUMNS} FROM sales",
    "load_reviews": f"""
WITH {d.REVIEWS_SQL}
SELECT * REPLACE (review_text || ':' || chr(10) || '"' || product_name || '", ok' AS review_text),
       DATE '2024-01-30' AS ingestion_date
FROM reviews""",
    "save_reviews_csv": f"WITH {d.REVIEWS_SQL} SELECT * FROM reviews",
    "catalogue_scan": f"WITH {d.CATALOGUE_SQL} SELECT * FROM catalogue",
    "landing_batches": f"""
WITH {d.SALES_SQL}
SELECT CASE WHEN sale_date < {_SPLIT} THEN 'ING_20010731_020000' ELSE 'ING_20010801_020000' END AS ingestion_id,
       CASE WHEN sale_date < {_SPLIT} THEN 'history' ELSE 'arriving' END AS source, count(*) AS record_count
FROM sales GROUP BY 1, 2""",
    "append_load": f"WITH {d.SALES_SQL} SELECT {_REVENUE} GROUP BY category",
    "replace_load": f"WITH {d.SALES_SQL} SELECT {_REVENUE} WHERE sale_date >= {_SPLIT} GROUP BY category",
    "partition_pruned_scan": f"""
WITH {d.SALES_SQL}
SELECT {_REVENUE} WHERE sale_date BETWEEN DATE '2001-08-01' - 30 AND DATE '2001-08-01' GROUP BY category""",
    "expire_partitions": f"""
WITH {d.SALES_SQL}
SELECT sale_month, count(*) AS "rows", count(DISTINCT sale_date) AS days
FROM sales WHERE sale_date >= DATE '2001-08-01' - 365 GROUP BY sale_month""",
    "backup_export": f"""
WITH {d.CLEANED_SQL},
recent AS (SELECT * FROM cleaned WHERE sale_date BETWEEN DATE '2001-08-01' - 30 AND DATE '2001-08-01'),
counts AS (
  SELECT 'raw_sales_data' AS table_name, count(*) AS live_rows FROM snapshots
  UNION ALL SELECT 'cleaned_sales_data', count(*) FROM cleaned
  UNION ALL SELECT 'daily_summary', count(*) FROM (SELECT DISTINCT sale_date, category FROM recent)
  UNION ALL SELECT 'product_performance', count(*) FROM (
    SELECT 1 FROM recent GROUP BY product_id, product_name, category HAVING sum(sales_count) > 0)
)
SELECT table_name, live_rows, live_rows AS exported_rows FROM counts""",
}
