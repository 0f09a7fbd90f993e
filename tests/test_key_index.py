"""The index of stored keys: exact, growing in buckets, reading few of them, and safe to replay."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.sources.key_index import KeyIndex
from pasarlens.streaming import ingest


def play(spark, root, batches, bucket_keys, merge_every=3, kind=T.LongType()):
    index = KeyIndex(spark, str(root), "id", kind, bucket_keys, merge_every)
    stored = []
    for n, keys in enumerate(batches):
        df = spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("id", kind)]))
        fresh, figures = index.fresh(df, n)
        stored.append(sorted((r["id"] for r in fresh.collect()), key=str))
        index.add(fresh, n, figures)
    return index, stored


def plain(batches):
    seen, out = set(), []
    for keys in batches:
        out.append(sorted((k for k in keys if k not in seen), key=str))
        seen |= set(keys)
    return out


@pytest.mark.parametrize("bucket_keys", [4, 64])
def test_only_unknown_keys_are_appended(spark, tmp_path, bucket_keys):
    """Known, new, repeated and null keys over many generations and merges."""
    rng = random.Random(bucket_keys)
    batches = [[rng.choice([None, *range(40 * n, 40 * n + 60)]) for _ in range(50)] for n in range(6)] + [[], [7, 7, 10_000]]
    index, stored = play(spark, tmp_path / "i", batches, bucket_keys)
    assert stored == plain(batches)
    report = index.report().orderBy("batch_id").collect()
    assert report[-1]["depth"] >= (3 if bucket_keys == 4 else 1) and report[-1]["merged"] == 5
    assert all(r["known"] <= r["candidates"] for r in report)


def test_few_buckets_are_read_for_new_keys(spark, tmp_path):
    index, stored = play(spark, tmp_path / "i", [range(20_000), range(20_000, 20_040), [5, 20_001, 90_000]], 256)
    report = index.report().orderBy("batch_id").collect()
    assert [len(s) for s in stored] == [20_000, 40, 1]
    new, mixed = report[1], report[2]
    # 128 buckets of the first batch; of 40 new keys hardly any passes the filter
    assert new["buckets"] >= 127 and new["known"] == 0 and new["touched"] <= 4
    assert mixed["known"] == 2 and 2 <= mixed["touched"] <= 4
    read = index.fresh(spark.range(3), 3)[0].inputFiles()
    assert read and all("/known/batch_id=3/" in file for file in read)


def test_a_bucket_gets_few_files_whatever_the_number_of_tasks(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), "id", T.LongType(), 256)
    index.add(spark.range(0, 20_000, 1, 16), 0, {"buckets": 0, "touched": 0, "candidates": 0, "known": 0})
    buckets = list((tmp_path / "i" / "keys").glob("depth=*/bucket=*"))
    files = list((tmp_path / "i" / "keys").rglob("*.parquet"))
    assert len(buckets) == 128 and len(files) <= 2 * len(buckets)


def test_false_positives_are_rare_when_buckets_are_full(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), "id", T.LongType(), 4096)
    index.add(spark.range(4 * 4096), 0, {"buckets": 0, "touched": 0, "candidates": 0, "known": 0})
    _, figures = index.fresh(spark.range(1_000_000, 1_100_000), 1)
    assert figures["known"] == 0 and figures["candidates"] <= 400


def test_a_replayed_batch_leads_to_the_same_index(spark, tmp_path):
    schema = "id string, v int"
    table, checkpoint = str(tmp_path / "t"), tmp_path / "c"

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        typed = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType())])
        ingest.append_new_keys(stream, table, str(checkpoint), "id", typed, bucket_keys=2)

    for rows in ([("a", 1), ("b", 1)], [("b", 2), ("c", 2), ("c", 3)], [("c", 4), ("d", 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run()
    before = sorted(map(tuple, spark.read.parquet(table).select("id", "v").collect()))
    assert before == [("a", 1), ("b", 1), ("c", 2), ("c", 3), ("d", 4)]
    keys = sorted(map(tuple, KeyIndex(spark, f"{table}_keys", "id", T.StringType()).report().collect()))
    (checkpoint / "commits" / "2").unlink()
    (checkpoint / "commits" / ".2.crc").unlink()
    run()
    assert sorted(map(tuple, spark.read.parquet(table).select("id", "v").collect())) == before
    assert sorted(map(tuple, KeyIndex(spark, f"{table}_keys", "id", T.StringType()).report().collect())) == keys
    assert spark.read.parquet(f"{table}_keys/keys").agg(F.count("*"), F.countDistinct("id")).first() == (4, 4)
