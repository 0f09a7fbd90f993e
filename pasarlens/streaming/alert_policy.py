"""A running alert policy: buckets closed by the watermark, and "held for so long" decided in keyed state.

Two streams follow each other. The first reduces each micro-batch of executions to one row per series and bucket and sets rows of
closed buckets aside as late. The second keeps the open buckets of a series and its run of breaching buckets in Spark's
state store; an event-time timer closes a bucket when the watermark passes its end, and the closed bucket is appended with
what the policy says about it. Only short rows reach the state, however many executions a bucket has.

Both streams go on from their checkpoint, and a replayed micro-batch replaces its own folder, so that a restart leads to the same
rows. The first one remembers the newest time seen with each batch and reads only what the batch before it has left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pasarlens.streaming.ingest import run_available

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Policy:
    """Buckets of ``seconds`` with more than ``threshold`` errors, ``held`` of them in a row; ``grace`` seconds for late rows."""

    seconds: int = 60
    threshold: int = 5
    held: int = 5
    grace: int = 600


@dataclass(frozen=True)
class Paths:
    """Folders of a policy's tables and checkpoints below one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


#: One row per series and bucket of a micro-batch; ``seen`` is the newest time up to and with it, cost is in millionths.
PARTIALS = "series string, bucket_end timestamp, executions bigint, errors bigint, cost bigint, seen timestamp, batch_id bigint"
PROGRESS = "seen timestamp, rows bigint, late bigint"
CLOSED = (
    "series string, bucket_end_ms bigint, executions bigint, errors bigint, cost bigint, run bigint, min_errors bigint, "
    "total_errors bigint, alert boolean"
)


def _replace(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def land_partials(executions: DataFrame, paths: Paths, policy: Policy, series: str | None = None) -> None:
    """Reduce each micro-batch of ``ts``, ``status`` and ``cost``. A row whose bucket the watermark has closed goes, as it came, to the
    ``late`` table instead; ``progress`` counts both. A null time belongs to no bucket and counts as late."""
    spark = executions.sparkSession
    name = F.lit("all") if series is None else F.col(series).cast("string")
    end = F.window("ts", f"{policy.seconds} seconds").getField("end").cast("timestamp")

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        before: datetime | None = None
        if batch_id > 0:
            # the folder of one batch, however many there have been
            before = spark.read.schema(PROGRESS).parquet(f"{paths.progress}/batch_id={batch_id - 1}").first()["seen"]
        closed = F.lit(False)
        if before is not None:
            closed = F.col("_end") <= F.lit(before) - F.make_dt_interval(secs=F.lit(policy.grace))
        timed = batch.where("ts IS NOT NULL").withColumn("_end", end).withColumn("_late", closed)
        rows = timed.unionByName(batch.where("ts IS NULL").withColumns({"_end": F.lit(None).cast("timestamp"), "_late": F.lit(True)}))
        rows = rows.persist()
        try:
            newest, total, late = rows.agg(F.max(F.col("ts").cast("timestamp")), F.count("*"), F.count_if("_late")).first()
            newest = max((t for t in (before, newest) if t is not None), default=None)
            per_bucket = rows.where("NOT _late").groupBy(name.alias("series"), F.col("_end").alias("bucket_end")).agg(
                F.count("*").alias("executions"),
                F.count_if(F.col("status") != "ok").alias("errors"),
                F.coalesce(F.sum((F.col("cost").cast("decimal(20,6)") * 1000000).cast("bigint")), F.lit(0)).alias("cost"),
            )
            _replace(per_bucket.withColumn("seen", F.lit(newest).cast("timestamp")), paths.partials, batch_id)
            if late:
                _replace(rows.where("_late").drop("_end", "_late"), paths.late, batch_id)
            row = [(newest, total, late)]
            _replace(spark.createDataFrame(row, PROGRESS).coalesce(1), paths.progress, batch_id)
        finally:
            rows.unpersist()

    run_available(executions, paths.partials_checkpoint, one_batch)


class CloseBuckets(StatefulProcessor):
    """Open buckets of a series, and its last breaching buckets in a row."""

    def __init__(self, policy: Policy):
        self.policy = policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "bucket_end bigint", "executions bigint, errors bigint, cost bigint")
        self.run = handle.getValueState("run", "last_end bigint, length bigint, errors array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            part = part.assign(end=part["bucket_end"].astype("datetime64[ms]").astype("int64"))
            for end, own in part.groupby("end")[["executions", "errors", "cost"]].sum().iterrows():
                at = (int(end),)
                if self.open.containsKey(at):
                    old = self.open.getValue(at)
                else:
                    old = (0, 0, 0)
                    self.handle.registerTimer(at[0])
                self.open.updateValue(at, tuple(int(a) + int(b) for a, b in zip(old, own, strict=True)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All buckets up to the timer, earliest first; those of earlier timers are closed already."""
        until = expiredTimerInfo.getExpiryTimeInMs()
        due = sorted((at[0], tuple(value)) for at, value in self.open.iterator() if at[0] <= until)
        out = []
        for end, (executions, errors, cost) in due:
            self.open.removeKey((end,))
            out.append((key[0], end, executions, errors, cost, *self._judge(end, errors)))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CLOSED.split(", ")])

    def _judge(self, end: int, errors: int) -> tuple:
        """Length of the run of breaching buckets that ends here, least and total errors of its last ``held``, and whether that
        is an alert. A bucket without executions breaks a run, as zero errors would."""
        held = self.policy.held
        if errors <= self.policy.threshold:
            self.run.clear()
            return 0, None, None, False
        last, length, recent = self.run.get() or (None, 0, [])
        if last is None or last != end - 1000 * self.policy.seconds:
            length, recent = 0, []
        length, recent = length + 1, [*recent, errors][-held:]
        self.run.update((end, length, recent))
        return length, min(recent), sum(recent), length >= held

    def close(self) -> None:
        pass


def close_buckets(spark: SparkSession, paths: Paths, policy: Policy, files_per_batch: int = 100) -> None:
    """Follow the landed partial counts and append every bucket that the watermark closes to the ``closed`` table."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        partials = spark.readStream.schema(PARTIALS).option("maxFilesPerTrigger", files_per_batch).parquet(paths.partials)
        closed = (
            partials.withWatermark("seen", f"{policy.grace} seconds")
            .groupBy("series")
            .transformWithStateInPandas(CloseBuckets(policy), CLOSED, "Append", "EventTime")
        )
        query = (
            closed.writeStream.format("parquet")
            .option("path", paths.closed)
            .option("checkpointLocation", paths.closed_checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)


def run_policy(executions: DataFrame, paths: Paths, policy: Policy, series: str | None = None) -> None:
    """Take in what has arrived and close what is due; to be called again as rows arrive."""
    land_partials(executions, paths, policy, series)
    close_buckets(executions.sparkSession, paths, policy)


def closed_buckets(spark: SparkSession, paths: Paths, policy: Policy) -> DataFrame:
    """The closed buckets with the columns of ``alerts.BUCKET_METRICS``, their series and what the policy says of them."""
    end = F.timestamp_millis("bucket_end_ms").cast("timestamp_ntz")
    return spark.read.schema(CLOSED).parquet(paths.closed).select(
        "series",
        (end - F.make_dt_interval(secs=F.lit(policy.seconds))).alias("bucket_start"),
        end.alias("bucket_end"),
        "executions",
        "errors",
        (F.col("cost").cast("decimal(20,0)") / 1000000).cast("double").alias("cost"),
        "run",
        "min_errors",
        "total_errors",
        "alert",
    )


def policy_alerts(spark: SparkSession, paths: Paths, policy: Policy) -> DataFrame:
    """Bucket ends at which the policy's condition has held for its duration."""
    return closed_buckets(spark, paths, policy).where("alert").select(
        "series", F.col("bucket_end").alias("alert_at"), "min_errors", "total_errors"
    )


def late_report(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row: how many rows have arrived and how many of them were set aside as late."""
    progress = spark.read.schema(PROGRESS).parquet(paths.progress)
    return progress.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("late"), F.lit(0)).alias("late"))
