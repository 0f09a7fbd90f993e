"""Features, summaries and clustered tables that are brought forward or read in part."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pasarlens.catalog import datasets, snapshots
from pasarlens.plans import features as f
from pasarlens.plans import sales_reports, summary_states
from pasarlens.sources import clustered
from pasarlens.sources.tables import write_table

START = date(2024, 1, 1)
CLEANED = (
    "product_id string, product_name string, category string, price double, discount_percent double, sales_count bigint, rating double, "
    "review_count bigint, sale_date date"
)


@pytest.fixture(scope="module")
def cleaned(spark):
    rng = random.Random(3)
    rows = []
    for product in range(12):
        days = sorted(rng.sample(range(90), 60 if product < 9 else 5))
        for day in days:
            for name in ["n"] * (1 + (rng.random() < 0.2)) + ["m"] * (rng.random() < 0.1):
                rows.append((f"p{product}", name, "c", rng.randint(1, 9) * 1.5, rng.choice([None, 5.0]), rng.randint(0, 9), 4.5, rng.randint(1, 5),
                             START + timedelta(days=day)))
    return spark.createDataFrame(rows, CLEANED).repartition(4)


def rows_of(df):
    return sorted(str(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("cuts", [[44], [10, 11, 40, 41, 88], [0, 89]])
def test_steps_equal_one_full_run(spark, cleaned, tmp_path, cuts):
    since, root = None, str(tmp_path / "f")
    for cut in [*cuts, 200]:
        until = START + timedelta(days=cut)
        f.advance_features(cleaned, root, since, until)
        if cut == cuts[-1]:
            f.advance_features(cleaned, root, since, until)  # a step may run again
        since = until
    assert rows_of(f.advanced_features(spark, root)) == rows_of(f.feature_history(cleaned))
    tail = spark.read.parquet(f"{root}/tail/upto={since}").groupBy("product_id").count()
    assert tail.agg(F.max("count")).first()[0] == f.TAIL_ROWS and tail.count() == 12


def test_a_step_reads_its_own_days_only(spark, cleaned, tmp_path):
    path, root = str(tmp_path / "c"), str(tmp_path / "f")
    write_table(cleaned, path, "overwrite", "sale_date")
    read = spark.read.parquet(path)
    f.advance_features(read, root, None, START + timedelta(days=80))
    # older days may go: the step needs its tail alone
    for day in range(60):
        for file in (tmp_path / "c" / f"sale_date={START + timedelta(days=day)}").glob("*"):
            file.write_bytes(b"")
    f.advance_features(read, root, START + timedelta(days=80), START + timedelta(days=100))
    assert rows_of(f.advanced_features(spark, root)) == rows_of(f.feature_history(cleaned))


def test_products_without_an_id_keep_their_history(spark, cleaned, tmp_path):
    """Rows without a product are a product of their own, in steps as in one run."""
    root, unknown = str(tmp_path / "f"), cleaned.withColumn("product_id", F.when(F.col("product_id") != "p1", F.col("product_id")))
    f.advance_features(unknown, root, None, START + timedelta(days=30))
    f.advance_features(unknown, root, START + timedelta(days=30), START + timedelta(days=100))
    assert rows_of(f.advanced_features(spark, root)) == rows_of(f.feature_history(unknown))


def test_a_step_gathers_tail_and_days_once(spark, cleaned, tmp_path, monkeypatch):
    plans, keep = [], f.stored

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    root = str(tmp_path / "f")
    f.advance_features(cleaned, root, None, START + timedelta(days=30))
    monkeypatch.setattr(f, "stored", noted)
    f.advance_features(cleaned, root, START + timedelta(days=30), START + timedelta(days=100))
    gathered = plans[-1]
    assert len(plans) == 2 and "Join" not in gathered
    assert gathered.count("Exchange hashpartitioning(product_id") == gathered.count("+- Window ") == 1


@pytest.mark.parametrize("product", ["p3", None])
def test_a_step_of_few_rows_leaves_other_tails_alone(spark, cleaned, tmp_path, monkeypatch, product):
    root, last = str(tmp_path / "f"), START + timedelta(days=100)
    rows = cleaned.withColumn("product_id", F.when(F.col("product_id") != "p1", F.col("product_id")))
    more = rows.limit(1).withColumns({"product_id": F.lit(product).cast("string"), "sale_date": F.lit(last)})
    rows = spark.createDataFrame([*rows.collect(), *more.collect()], CLEANED)
    plans, keep = [], f.stored

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    f.advance_features(rows, root, None, START + timedelta(days=90))
    monkeypatch.setattr(f, "stored", noted)
    f.advance_features(rows, root, START + timedelta(days=90), last)
    assert "Join" in plans[-1]
    assert rows_of(f.advanced_features(spark, root)) == rows_of(f.feature_history(rows))
    tail = spark.read.parquet(f"{root}/tail/upto={last}").groupBy("product_id").count()
    assert tail.agg(F.max("count")).first()[0] == f.TAIL_ROWS and tail.count() == 12


def test_a_step_cleans_its_own_snapshots_only(spark, tmp_path, monkeypatch):
    steps = [*snapshots.FEATURE_STEPS]
    shipped = [datetime(1996, 5, 1), datetime(1997, 1, 1, 23), datetime(1997, 1, 2), datetime(2001, 6, 8, 12), datetime(2001, 6, 9)]
    lines = [(i, 1, 1, 1, 2.0, 100.0, 0.1, at) for i, at in enumerate(shipped)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "n", "t", 5)], "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    seen, keep = [], f.advance_features

    def noted(cleaned, root, since, until):
        seen.append(sorted(r["sale_date"] for r in cleaned.select("sale_date").collect()))
        keep(cleaned, root, since, until)

    monkeypatch.setattr(f, "advance_features", noted)
    found = snapshots.incremental_features(spark, str(tmp_path))
    assert seen == [[at.date() for at in shipped if (k == 0 or at.date() > steps[k - 1]) and at.date() <= steps[k]] for k in range(4)]
    assert rows_of(found) == rows_of(f.ml_features(datasets.cleaned(spark, str(tmp_path))))


SALES = "transaction_id string, product_id string, product_name string, category string, quantity bigint, total_amount double, seller_name string, sale_date date"


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(5)
    rows = [(f"t{i}", f"p{i % 7}", f"n{i % 7}", f"c{i % 5}", rng.randint(1, 5), rng.choice([1.25, 9.5, 9.5, None, rng.random() * 9]),
             rng.choice([None, *[f"s{j}" for j in range(40)]]), rng.choice([None, START, START + timedelta(1), START + timedelta(2)]))
            for i in range(600)]
    return spark.createDataFrame(rows, SALES).repartition(3)


@pytest.mark.parametrize("parts", [1, 4])
def test_merged_states_equal_the_summary(spark, sales, tmp_path, parts):
    created = datetime(2024, 2, 1)
    root, arrivals = str(tmp_path / "s"), str(tmp_path / "in")
    for part in range(parts):
        sales.where(F.pmod(F.xxhash64("transaction_id"), F.lit(parts)) == part).write.mode("append").parquet(arrivals)
        summary_states.stream_states(spark.readStream.schema(sales.schema).parquet(arrivals), root, str(tmp_path / "c"))
    found = summary_states.stored_summary(spark, root, created)
    assert rows_of(found) == rows_of(sales_reports.daily_summary(sales, created))
    numbers = spark.read.schema(summary_states.DICTIONARY).parquet(f"{root}/sellers").collect()
    assert sorted(r["number"] for r in numbers) == list(range(40)) and len({r["seller_name"] for r in numbers}) == 40


def test_merging_in_any_order_and_twice_by_parts(spark, sales):
    """Merged states are states: merging merged parts gives the whole."""
    parts = [summary_states.day_states(sales.where(F.col("quantity") % 3 == k)) for k in range(3)]
    once = summary_states.merge_day_states(parts[2].unionByName(parts[0]).unionByName(parts[1]))
    twice = summary_states.merge_day_states(summary_states.merge_day_states(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    assert rows_of(once) == rows_of(twice) == rows_of(summary_states.day_states(sales))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", *[f"c{i:02}" for i in range(30)]]) if rng.random() < 0.6 else "hot", rng.choice([None, *[f"s{i:03}" for i in range(200)]]), i)
            for i in range(8000)]
    df = spark.createDataFrame(rows, "category string, seller string, id bigint").repartition(5)
    path = str(tmp_path_factory.mktemp("t") / "clustered")
    clustered.write_clustered(df, path, ["category", "seller"], 64)
    return path, rows


def test_a_filter_on_any_column_reads_a_fraction_of_the_files(spark, table):
    path, rows = table
    files = spark.read.parquet(f"{path}_ranges").count()
    assert files >= 48
    for column, place, value in (("category", 0, "c07"), ("seller", 1, "s100"), ("seller", 1, "s003"), ("seller", 1, None)):
        wanted = {column: value}
        assert sorted(r["id"] for r in clustered.read_clustered(spark, path, wanted).collect()) == [r[2] for r in rows if r[place] == value]
        assert len(clustered.matching_files(spark, path, wanted)) <= files / 3
    both = clustered.matching_files(spark, path, {"category": "c07", "seller": "s100"})
    assert len(both) <= 6
    assert clustered.read_clustered(spark, path, {"seller": "zzz"}).count() == 0


def test_frequent_values_are_spread_over_files(spark, table):
    path, _ = table
    rows = [r["n"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert max(rows) <= 4 * sum(rows) / len(rows)


def test_interleaved_bits(spark):
    row = spark.range(1).select(clustered.interleaved([F.lit(0b101).cast("bigint"), F.lit(0b011).cast("bigint")], 3).alias("z")).first()
    assert row["z"] == 0b011011
    with pytest.raises(ValueError):
        clustered.interleaved([F.lit(1)] * 6)
