"""Order statistics, row-exact splits and frequent keys against plain versions."""

import random
import statistics
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pasarlens.operators import selection
from pasarlens.operators.frequent import frequent_duplicates
from pasarlens.operators.ranks import numbered
from pasarlens.plans import features as f


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [5.0] * 9, [0.0, -0.0, 1e-300, 1e300, -1e300, 7.5], [1e308, -1e308, 3.0, 4.0],
    [1 + i * 2**-52 for i in range(11)], [1.0, 1e15, 1e15 + 0.125, 1e15 + 0.25, 2e15],
])
def test_median_equals_a_sort(spark, values):
    rows = [(v,) for v in [*values, None, float("nan")]]
    assert selection.exact_median(spark.createDataFrame(rows, "x double"), F.col("x")) == statistics.median(values)


def test_median_and_ranks_of_many_values(spark, monkeypatch):
    monkeypatch.setattr(selection, "INTERVALS", 8)
    rng = random.Random(1)
    values = [rng.choice([rng.gauss(0, 1), rng.expovariate(1e-6), 0.5]) for _ in range(2001)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    ranked = sorted(values)
    ranks = [0, 1, 700, 1000, 1999, 2000]
    assert selection.nth_smallest(df, F.col("x"), ranks, ranked[0], ranked[-1]) == [ranked[k] for k in ranks]
    assert selection.exact_median(df, F.col("x")) == statistics.median(values)


def test_median_of_nothing_and_of_infinite_values(spark):
    assert selection.exact_median(spark.createDataFrame([(None,)], "x double"), F.col("x")) is None
    with pytest.raises(ValueError):
        selection.exact_median(spark.createDataFrame([(float("inf"),), (1.0,)], "x double"), F.col("x"))


def test_numbers_follow_the_order_over_many_ranges(spark):
    rows = [(random.Random(i).random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, id bigint").repartition(7)
    found = {r["id"]: r["rank"] for r in numbered(df, [F.col("x")]).collect()}
    assert [found[i] for _, i in sorted(rows)] == list(range(3000))
    assert numbered(df.where("false"), [F.col("x")]).count() == 0


@pytest.mark.parametrize("fraction", [0.2, 0.5, 0.05])
@pytest.mark.parametrize("n", [0, 1, 3, 5, 40, 97])
def test_split_holds_out_exactly_the_last_rows(spark, n, fraction):
    rng = random.Random(n)
    start = date(2024, 1, 1)
    # few days, one of them with most rows, and null keys
    rows = [(start + timedelta(days=rng.choice([0, 1, 1, 1, 2])), rng.choice(["a", None, "b"]), f"n{i}", None) for i in range(n)]
    df = spark.createDataFrame([*rows, (None, "x", "y", "z")], "sale_date date, product_id string, product_name string, category string")
    got = {r["product_name"] for r in f.seq_split_rows(df.repartition(3), eval_fraction=fraction).where("is_eval").collect()}
    ordered = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    kept = int(round(n * (1 - fraction) * 1000) // 1000)
    assert got == {r[2] for r in ordered[kept:]}


def plain(keys, limit):
    counts = [(k, n) for k, n in Counter(keys).items() if n > 1]
    return sorted(counts, key=lambda x: (-x[1], x[0] is not None, x[0] if x[0] is not None else 0))[:limit]


@pytest.mark.parametrize("counters", [4096, 16, 2])
def test_frequent_keys_equal_full_counts(spark, counters):
    """With few counters nothing can be proved, and the keys are counted in full."""
    rng = random.Random(counters)
    keys = [2**53 + 1] * 50 + [2**53] * 40 + [None] * 30 + [rng.randrange(500) for _ in range(600)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "id bigint").repartition(6)
    for limit in (1, 3, 100):
        assert [tuple(r) for r in frequent_duplicates(df, "id", limit, counters).collect()] == plain(keys, limit)


def test_frequent_keys_of_unique_and_no_rows(spark):
    assert frequent_duplicates(spark.range(100).withColumnRenamed("id", "k"), "k", 5).count() == 0
    assert frequent_duplicates(spark.range(0).withColumnRenamed("id", "k"), "k", 5).count() == 0


def test_proved_keys_are_not_counted_in_full(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    found = frequent_duplicates(df.repartition(4), "k", 1, counters=64)
    assert [tuple(r) for r in found.collect()] == [("hot", 5000)]
    assert "duplicates" in found.inputFiles()[0]
