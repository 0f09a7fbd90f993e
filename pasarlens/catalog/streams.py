"""File-stream jobs and alerts, read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens.catalog import datasets as d
from pasarlens.catalog.datasets import AS_OF
from pasarlens.catalog.loads import KEY, envelope_folder
from pasarlens.catalog.sales import SUMMARY_SQL
from pasarlens.catalog.snapshots import PER_DAY_SQL, with_revenue
from pasarlens.plans import summary_states
from pasarlens.session import fresh_path
from pasarlens.streaming import alert_policy, alerts, ingest

HOUR, DAY = 3600, 86400
ALERT_ERRORS = 1  # hourly error counts in the given events are small


def stream_ingest(spark, sf):
    table, rejected, checkpoint = (fresh_path(spark, n) for n in ("table", "rejected", "checkpoint"))
    ingest.ingest(ingest.stream_envelopes(spark, envelope_folder(spark, sf)), table, rejected, checkpoint, AS_OF)
    return spark.read.parquet(table).drop("batch_id")


def stream_rejected(spark, sf):
    """What the ingest turns away, and what it loads, when one file per region is cut short and one holds no data."""
    landed = envelope_folder(spark, sf)
    for kind, text in (("cut", '{"metadata": {"source": "%s"'), ("bare", '{"metadata": {"source": "%s"}}')):
        files = d.table(spark, sf, "region").select(
            F.concat(F.lit(f"{kind}_"), F.col("r_name")).alias("ingestion_id"), F.format_string(text, "r_name").alias("value")
        )
        files.write.mode("append").partitionBy("ingestion_id").text(landed)
    table, rejected, checkpoint = (fresh_path(spark, n) for n in ("table", "rejected", "checkpoint"))
    ingest.ingest(ingest.stream_envelopes(spark, landed), table, rejected, checkpoint, AS_OF)
    reasons = spark.read.parquet(rejected).groupBy("reason").agg(
        F.count("*").alias("rows"), F.count("record").alias("with_text")
    )
    loaded = spark.read.parquet(table).agg(F.lit("loaded").alias("reason"), F.count("*").alias("rows"))
    return reasons.unionByName(loaded.withColumn("with_text", F.col("rows")))


def stream_validate(spark, sf):
    results = fresh_path(spark, "results")
    ingest.validate(
        ingest.stream_documents(spark, envelope_folder(spark, sf)), results, fresh_path(spark, "checkpoint")
    )
    return (
        spark.read.parquet(results)
        .groupBy("is_valid")
        .agg(F.sum("valid_records").alias("valid_records"), F.sum("invalid_records").alias("invalid_records"))
    )


def _run_twice(spark, df, day, job):
    """Land the stored rows, run the stream job, land the newer rows and run it again from its checkpoint."""
    arrivals = fresh_path(spark, "arrivals")
    for part in (d.history(df, day), d.arriving(df, day)):
        part.write.mode("append").parquet(arrivals)
        job(spark.readStream.schema(df.schema).parquet(arrivals))


def stream_daily_summary(spark, sf):
    raw, summary, checkpoint = (fresh_path(spark, n) for n in ("raw", "summary", "checkpoint"))
    rows = with_revenue(spark, sf)
    _run_twice(
        spark,
        rows,
        "ingestion_date",
        lambda batches: ingest.refresh_daily_summary(batches, raw, summary, checkpoint, rows.schema),
    )
    return spark.read.parquet(summary).drop("month")


def stream_append_new(spark, sf):
    table, checkpoint = fresh_path(spark, "table"), fresh_path(spark, "checkpoint")
    sales = d.sales(spark, sf)
    _run_twice(
        spark,
        sales,
        "sale_date",
        lambda batches: ingest.append_new_keys(batches, table, checkpoint, KEY, sales.schema),
    )
    return spark.read.parquet(table).drop("batch_id")


def summary_from_states(spark, sf):
    """Sales arrive in two parts that share days; the summary is merged from the states of both."""
    root, checkpoint, arrivals = (fresh_path(spark, n) for n in ("states", "checkpoint", "arrivals"))
    sales = d.sales(spark, sf)
    for part in (F.col("discount_percent") < 5, F.col("discount_percent") >= 5):
        sales.where(part).write.mode("append").parquet(arrivals)
        summary_states.stream_states(spark.readStream.schema(sales.schema).parquet(arrivals), root, checkpoint)
    return summary_states.stored_summary(spark, root, d.CREATED_AT)


def _buckets(spark, sf, seconds):
    # A file stream needs a folder or a pattern; this one fits the table alone, kept as one file or as a folder.
    stream = spark.readStream.schema(d.table(spark, sf, "events").schema).parquet(f"{sf}/events.parque[t]")
    table, checkpoint = fresh_path(spark, "buckets"), fresh_path(spark, "checkpoint")
    return alerts.stream_bucket_metrics(d.executions(stream), table, checkpoint, seconds)


def late_rows(spark, sf):
    """The newer half of the events arrives first, so the older half is late."""
    table, checkpoint, arrivals = (fresh_path(spark, n) for n in ("buckets", "checkpoint", "arrivals"))
    events = d.table(spark, sf, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.where(F.col("ts") >= middle), events.where(F.col("ts") < middle)):
        part.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        alerts.stream_bucket_metrics(d.executions(stream), table, checkpoint, HOUR)
    return alerts.late_rows(spark, table)


#: Hourly buckets with more than one error, three in a row, two hours for late rows.
POLICY = alert_policy.Policy(seconds=HOUR, threshold=1, held=3, grace=2 * HOUR)
#: Days of January 2024 that arrive together, in this order: the third part is late.
ARRIVALS = ((1, 8), (16, 24), (8, 16), (24, 32))


def _policy_run(spark, sf):
    """Events land in four parts; after each the policy goes on from its checkpoints."""
    arrivals, paths = fresh_path(spark, "arrivals"), alert_policy.Paths(fresh_path(spark, "policy"))
    events = d.table(spark, sf, "events")
    for first, last in ARRIVALS:
        events.where(F.dayofmonth("ts").between(first, last - 1)).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        alert_policy.run_policy(d.executions(stream), paths, POLICY)
    return paths


def policy_buckets(spark, sf):
    return alert_policy.closed_buckets(spark, _policy_run(spark, sf), POLICY).drop("series")


def policy_alerts(spark, sf):
    return alert_policy.policy_alerts(spark, _policy_run(spark, sf), POLICY).drop("series")


def policy_late(spark, sf):
    return alert_policy.late_report(spark, _policy_run(spark, sf))


QUERIES = {
    "policy_buckets": policy_buckets,
    "policy_alerts": policy_alerts,
    "policy_late": policy_late,
    "stream_ingest": stream_ingest,
    "stream_rejected": stream_rejected,
    "stream_validate": stream_validate,
    "late_rows": late_rows,
    "stream_daily_summary": stream_daily_summary,
    "stream_append_new": stream_append_new,
    "summary_from_states": summary_from_states,
    "error_alerts": lambda spark, sf: alerts.error_alerts(_buckets(spark, sf, HOUR), HOUR, ALERT_ERRORS),
    "cost_alerts": lambda spark, sf: alerts.cost_alerts(_buckets(spark, sf, DAY)),
    "execution_rate": lambda spark, sf: alerts.execution_rate(_buckets(spark, sf, 60), 60),
    "error_rate": lambda spark, sf: alerts.error_rate(_buckets(spark, sf, HOUR)),
}


def _buckets_sql(seconds: int) -> str:
    width = f"INTERVAL {seconds} SECOND"
    return f"""
counted AS (
  SELECT time_bucket({width}, ts, TIMESTAMP '1970-01-01') AS bucket_start, count(*) AS executions,
         count(*) FILTER (WHERE event_type = 'error') AS errors,
         CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS cost
  FROM events GROUP BY 1
),
buckets AS (
  SELECT *, bucket_start + {width} AS bucket_end FROM counted
)"""


_POLICY_SQL = f"""
arrived AS (
  SELECT *, CASE WHEN day(ts) < 8 THEN 1 WHEN day(ts) < 16 THEN 3 WHEN day(ts) < 24 THEN 2 ELSE 4 END AS batch,
         time_bucket(INTERVAL {HOUR} SECOND, ts, TIMESTAMP '1970-01-01') + INTERVAL {HOUR} SECOND AS bucket_end
  FROM events WHERE ts IS NOT NULL
),
newest AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) AS seen FROM arrived GROUP BY batch),
judged AS (
  SELECT a.*, coalesce(a.bucket_end <= n.seen - INTERVAL {2 * HOUR} SECOND, false) AS late
  FROM arrived a LEFT JOIN newest n ON n.batch = a.batch - 1
),
closed AS (
  SELECT bucket_end, count(*) AS executions, count(*) FILTER (WHERE event_type = 'error') AS errors,
         CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS cost
  FROM judged WHERE NOT late GROUP BY bucket_end
  HAVING bucket_end <= (SELECT max(ts) FROM arrived) - INTERVAL {2 * HOUR} SECOND
),
breaching AS (
  SELECT *, bucket_end - row_number() OVER (ORDER BY bucket_end) * INTERVAL {HOUR} SECOND AS grp
  FROM closed WHERE errors > 1
),
runs AS (
  SELECT bucket_end, row_number() OVER w AS run, min(errors) OVER three AS min_errors,
         CAST(sum(errors) OVER three AS BIGINT) AS total_errors
  FROM breaching
  WINDOW w AS (PARTITION BY grp ORDER BY bucket_end),
         three AS (PARTITION BY grp ORDER BY bucket_end ROWS 2 PRECEDING)
)"""

ORACLE = {
    "policy_buckets": f"""
WITH {_POLICY_SQL}
SELECT bucket_end - INTERVAL {HOUR} SECOND AS bucket_start, bucket_end, executions, errors, cost, coalesce(run, 0) AS run,
       min_errors, total_errors, coalesce(run >= 3, false) AS alert
FROM closed LEFT JOIN runs USING (bucket_end)""",
    "policy_alerts": f"""
WITH {_POLICY_SQL} SELECT bucket_end AS alert_at, min_errors, total_errors FROM runs WHERE run >= 3""",
    "policy_late": f"""
WITH {_POLICY_SQL} SELECT count(*) AS "rows", count(*) FILTER (WHERE late) AS late FROM judged""",
    "stream_ingest": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT product_id, product_name, category, price, original_price, CAST(discount_percent AS BIGINT) AS discount_percent,
       sales_count, rating, review_count, stock, seller_name, seller_location, DATE '2001-08-01' AS ingestion_date,
       DATE '2001-08-01' AS sale_date, price * sales_count AS revenue
FROM snapshots WHERE product_id IS NOT NULL AND price IS NOT NULL""",
    "stream_rejected": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT CASE WHEN product_id IS NOT NULL AND price IS NOT NULL THEN 'loaded' ELSE 'missing key' END AS reason,
       count(*) AS "rows", count(*) AS with_text FROM snapshots GROUP BY 1
UNION ALL SELECT 'unreadable file', count(*), count(*) FROM region
UNION ALL SELECT 'no data', count(*), 0 FROM region""",
    "late_rows": """
SELECT count(*) AS "rows", count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS late FROM events""",
    "stream_validate": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT true AS is_valid, count(*) FILTER (WHERE product_id IS NOT NULL AND price IS NOT NULL) AS valid_records,
       count(*) FILTER (WHERE product_id IS NULL OR price IS NULL) AS invalid_records
FROM snapshots""",
    "stream_daily_summary": f"WITH {d.SNAPSHOTS_SQL}, {PER_DAY_SQL} SELECT * FROM per_day",
    "summary_from_states": SUMMARY_SQL,
    "stream_append_new": f"""
WITH {d.SALES_SQL}
SELECT * FROM sales WHERE sale_date < DATE '2000-01-01'
UNION ALL
SELECT * FROM sales b WHERE sale_date >= DATE '2000-01-01' AND NOT EXISTS (
  SELECT 1 FROM sales t WHERE t.sale_date < DATE '2000-01-01' AND t.transaction_id = b.transaction_id)""",
    "error_alerts": f"""
WITH {_buckets_sql(HOUR)},
held AS (
  SELECT a.bucket_end AS alert_at, count(*) AS n, min(b.errors) AS min_errors, sum(b.errors) AS total_errors
  FROM buckets a JOIN buckets b
    ON b.bucket_end > a.bucket_end - INTERVAL {5 * HOUR} SECOND AND b.bucket_end <= a.bucket_end
  WHERE b.errors > {ALERT_ERRORS} GROUP BY a.bucket_end
)
SELECT alert_at, min_errors, CAST(total_errors AS BIGINT) AS total_errors FROM held WHERE n = 5""",
    "cost_alerts": f"""
WITH {_buckets_sql(DAY)}
SELECT CAST(bucket_start AS DATE) AS day, cost AS daily_cost FROM buckets WHERE cost > 50""",
    "execution_rate": f"WITH {_buckets_sql(60)} SELECT bucket_start, executions / 60 AS per_second FROM buckets",
    "error_rate": f"""
WITH {_buckets_sql(HOUR)}
SELECT bucket_start, executions, errors, errors / executions AS error_rate FROM buckets
WHERE errors / executions > 0.1""",
}
