from datetime import date

import pytest
from pyspark.sql import functions as F

from pasarlens.operators import keys as k
from pasarlens.sources import tables

SCHEMA = "id string, v bigint, w bigint"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_append_new_keeps_copies_and_knows_nulls(spark):
    target = frame(spark, ("a", 1, 1), (None, 1, 1))
    batch = frame(spark, ("a", 9, 9), ("b", 1, 1), ("b", 1, 1), (None, 2, 2))
    assert rows(k.append_new(batch, target, "id")) == [("b", 1, 1), ("b", 1, 1)]
    assert tuple(k.append_new_stats(batch, target, "id").first()) == (4, 2, 2, "success")


def test_append_new_without_target_or_key(spark):
    batch = frame(spark, ("a", 1, 1), ("a", 1, 1))
    assert k.append_new(batch, None, "id").count() == 2
    assert k.append_new(batch, frame(spark, ("a", 1, 1)), "other").count() == 2
    assert tuple(k.append_new_stats(batch, None, "id").first()) == (2, 0, 2, "success")
    assert k.append_new(batch, frame(spark).limit(0), "id").count() == 2


def test_append_twice_adds_nothing(spark):
    target = frame(spark, ("a", 1, 1))
    batch = frame(spark, ("a", 2, 2), ("c", 3, 3))
    merged = target.unionByName(k.append_new(batch, target, "id"))
    assert k.append_new(batch, merged, "id").count() == 0


def test_upsert_updates_listed_columns_and_inserts_the_rest(spark):
    target = frame(spark, ("a", 1, 1), ("a", 2, 2), ("b", 3, 3), (None, 4, 4))
    source = frame(spark, ("a", 10, 10), ("n", 5, 5), ("n", 6, 6), (None, 7, 7))
    assert rows(k.upsert(target, source, "id", ["v"])) == sorted(
        [("a", 10, 1), ("a", 10, 2), ("b", 3, 3), (None, 4, 4), ("n", 5, 5), ("n", 6, 6), (None, 7, 7)], key=repr
    )
    assert tuple(k.upsert_stats(target, source, "id").first()) == (2, 3, 5)


def test_upsert_without_columns_changes_nothing_matched(spark):
    target, source = frame(spark, ("a", 1, 1)), frame(spark, ("a", 9, 9), ("b", 2, 2))
    assert rows(k.upsert(target, source, "id")) == [("a", 1, 1), ("b", 2, 2)]


def test_upsert_can_set_null(spark):
    assert rows(k.upsert(frame(spark, ("a", 1, 1)), frame(spark, ("a", None, 2)), "id", ["v"])) == [("a", None, 1)]


def test_upsert_fails_on_ambiguous_match(spark):
    target, source = frame(spark, ("a", 1, 1)), frame(spark, ("a", 2, 2), ("a", 3, 3))
    with pytest.raises(Exception, match="several source rows"):
        k.upsert(target, source, "id", ["v"]).collect()


def test_upsert_partitioned_moves_rows_and_drops_empty_partitions(spark, tmp_path):
    schema = "id string, v bigint, d date"
    jan, feb, mar = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    table, staging = str(tmp_path / "t"), str(tmp_path / "s")
    stored = frame(spark, ("a", 1, jan), ("b", 2, feb), ("c", 3, mar), schema=schema)
    tables.replace_table(stored, table, "d")
    untouched = sorted(p.name for p in (tmp_path / "t" / "d=2024-03-01").iterdir())
    batch = frame(spark, ("a", 10, feb), ("n", 5, feb), schema=schema)
    touched = tables.upsert_table(spark, table, staging, batch, "id", ["v", "d"], "d")
    assert sorted(touched) == [jan, feb]
    assert rows(spark.read.parquet(table).select("id", "v", "d")) == [
        ("a", 10, feb), ("b", 2, feb), ("c", 3, mar), ("n", 5, feb)
    ]
    assert not (tmp_path / "t" / "d=2024-01-01").exists()
    assert sorted(p.name for p in (tmp_path / "t" / "d=2024-03-01").iterdir()) == untouched


def dated(spark):
    return frame(
        spark,
        ("a", date(2024, 1, 2), 1),
        ("a", date(2024, 1, 1), 2),
        ("a", None, 3),
        ("b", date(2024, 1, 1), 5),
        ("b", date(2024, 1, 1), 4),
        (None, date(2024, 1, 1), 6),
        (None, date(2024, 1, 1), 6),
        schema="id string, ingestion_date date, v bigint",
    )


def test_remove_duplicates(spark):
    first = {r.id: r.v for r in k.remove_duplicates(dated(spark), "id", "first").collect()}
    last = {r.id: r.v for r in k.remove_duplicates(dated(spark), "id", "last").collect()}
    assert first == {"a": 3, "b": 4, None: 6}  # an unknown date sorts first
    assert last == {"a": 1, "b": 4, None: 6}
    with pytest.raises(ValueError):
        k.remove_duplicates(dated(spark), "id", "any")


def test_remove_duplicates_twice_is_once(spark):
    once = k.remove_duplicates(dated(spark), "id")
    assert rows(k.remove_duplicates(once, "id")) == rows(once)


def test_check_duplicates(spark):
    assert [tuple(r) for r in k.check_duplicates(dated(spark), "id").collect()] == [("a", 3), (None, 2), ("b", 2)]


def test_hot_key_join_is_split(spark):
    """A third of the batch on one key: the anti join splits that partition and loses nothing."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n = 240_000
        key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
        batch = spark.range(0, n, 1, 16).select(key.alias("key"), F.col("id").alias("v"))
        target = spark.range(0, n, 7).select(F.col("id").alias("key"))
        joined = k.append_new(batch, target, "key")
        kept = joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert len(kept) == sum(1 for i in range(n) if i % 3 == 0 or i % 7 != 0)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
