"""Session builder for local runs and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def build_session(app: str = "pasarlens", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session; a session that exists or a submitted master is used instead."""
    builder = SparkSession.builder.appName(app)
    if "PYSPARK_GATEWAY_PORT" not in os.environ and SparkSession.getActiveSession() is None:
        builder = builder.master(f"local[{cores}]")
    return (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; a cluster
    without it is refused, because executors could not see a driver-local path.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="pasarlens-")
        spark.sparkContext.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


#: Whether shuffle files go when the job that made them ends; else they stay until the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For writes of a job of several steps: nothing reads their shuffles again, and the disk must not hold those of all steps at once."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{work_root(spark)}/pasarlens/{uuid.uuid4().hex}/{label}"
