"""The alert policy over many small micro-batches: closing, holding, late rows, series and restarts."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pasarlens.streaming import alert_policy

START = datetime(2024, 1, 1, 12)
SCHEMA = "ts timestamp_ntz, status string, cost double, name string"
POLICY = alert_policy.Policy(seconds=60, threshold=1, held=2, grace=120)


def row(minute, status="failed", name="a", second=5):
    return (START + timedelta(minutes=minute, seconds=second), status, 0.25, name)


BATCHES = [
    [row(0), row(0), row(1), row(1), row(1, "ok")],
    [row(0, "ok", second=59), row(2), row(2), row(3), row(2, name="b"), row(2, name="b")],
    [row(9)],
    # minute 1 has been closed by minute 9, minute 8 is still open; a null time belongs nowhere
    [row(1), row(8), row(8), (None, "failed", 0.25, "a")],
    [row(30, "ok"), row(30, "ok", name="b")],
]


def play(spark, root, batches, series="name"):
    paths = alert_policy.Paths(str(root / "policy"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(root / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(root / "in"))
        alert_policy.run_policy(stream, paths, POLICY, series)
    return paths


def minute(t):
    return (t - START) // timedelta(minutes=1)


@pytest.fixture(scope="module")
def played(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("alerts")
    return root, play(spark, root, BATCHES)


def test_buckets_close_with_the_watermark(spark, played):
    _, paths = played
    rows = alert_policy.closed_buckets(spark, paths, POLICY).collect()
    found = sorted((r.series, minute(r.bucket_start), r.executions, r.errors, r.run, r.total_errors, r.alert) for r in rows)
    assert found == [
        ("a", 0, 3, 2, 1, 2, False), ("a", 1, 3, 2, 2, 4, True), ("a", 2, 2, 2, 3, 4, True), ("a", 3, 1, 1, 0, None, False),
        ("a", 8, 2, 2, 1, 2, False), ("a", 9, 1, 1, 0, None, False), ("b", 2, 2, 2, 1, 2, False),
    ]
    assert {r.cost for r in rows if r.executions == 3} == {0.75}
    alerts = alert_policy.policy_alerts(spark, paths, POLICY).collect()
    assert sorted(minute(r.alert_at) for r in alerts) == [2, 3] and all(r.min_errors == 2 for r in alerts)


def test_late_rows_are_set_aside_whole(spark, played):
    _, paths = played
    assert tuple(alert_policy.late_report(spark, paths).first()) == (18, 2)
    late = spark.read.parquet(paths.late).select("ts", "status", "cost", "name").collect()
    assert sorted(((r.ts and minute(r.ts)), r.name) for r in late if r.ts) == [(1, "a")] and len(late) == 2


def test_a_batch_reads_only_what_the_one_before_left(spark, played, tmp_path):
    root, _ = played
    shutil.copytree(root, tmp_path / "copy")
    paths = alert_policy.Paths(str(tmp_path / "copy" / "policy"))
    # the copy has other paths, so its stream is begun anew; older folders are not needed
    before = spark.read.parquet(paths.progress).agg(F.sum("rows")).first()[0]
    for folder in (tmp_path / "copy" / "policy" / "progress").glob("batch_id=[0-3]"):
        shutil.rmtree(folder)
    left = spark.read.parquet(paths.progress).collect()
    assert len(left) == 1 and before == 18 and minute(left[0].seen) == 30


def test_splitting_the_arrivals_differently_closes_the_same_buckets(spark, played, tmp_path):
    """Everything in order and in one batch: late rows are not late then, all else is equal."""
    _, paths = played
    timely = [r for batch in BATCHES for r in batch if r[0] is not None and r is not BATCHES[3][0]]
    once = play(spark, tmp_path, [timely])
    columns = ["series", "bucket_end", "executions", "errors", "cost", "run", "min_errors", "total_errors", "alert"]

    def of(p):
        return sorted(map(str, alert_policy.closed_buckets(spark, p, POLICY).select(columns).collect()))

    assert of(once) == of(paths)


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    """The first stream stopped before it could commit its last batch."""
    paths = play(spark, tmp_path, BATCHES[:2], series=None)
    before = sorted(map(str, spark.read.parquet(paths.partials).collect()))
    commits = sorted((tmp_path / "policy" / "partials_checkpoint" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink()
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    alert_policy.run_policy(stream, paths, POLICY)
    assert sorted(map(str, spark.read.parquet(paths.partials).collect())) == before
    assert tuple(alert_policy.late_report(spark, paths).first()) == (11, 0)
