"""Loads, forecasts and the model refresh keep what they write and shuffle small."""

import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pasarlens.catalog import datasets as d
from pasarlens.catalog import learning, loads
from pasarlens.operators import keys
from pasarlens.plans import features, model_store
from pasarlens.session import shuffles_dropped
from pasarlens.sources import landing, tables

SF_DIR = "/root/testdata/sf0.001"
START = date(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_batches_are_compressed_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TEXT_RECORDS", 100)
    rows = spark.range(0, 1000, 1, 2).withColumn("name", F.lit("Kopi"))
    landing.write_landing(rows, str(tmp_path / "raw"), datetime(2024, 1, 2), "api")
    files = [p.name for p in (tmp_path / "raw").rglob("part-*")]
    assert len(files) == 10 and all(name.endswith(".json.gz") for name in files)
    assert [tuple(r) for r in landing.landing_batches(spark, str(tmp_path / "raw"), rows.schema).collect()] == [("ING_20240102_000000", "api", 1000)]
    assert landing.new_files(spark, str(tmp_path / "raw"), date.today() - timedelta(days=1)).where("file_path like '%.gz'").count() == 10


@pytest.fixture
def no_small_tables(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in settings}
    for name in settings:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_few_sellers_are_broadcast_and_many_are_not(spark, no_small_tables, monkeypatch):
    few = d.sales(spark, SF_DIR)
    assert "BroadcastHashJoin [l_suppkey" in plan(few) and "SortMergeJoin [l_partkey" in plan(few)
    monkeypatch.setattr(d, "FEW_SUPPLIERS", 0)
    many = d.sales(spark, SF_DIR)
    assert "Broadcast" not in plan(many)
    assert few.exceptAll(many).count() == 0 == many.exceptAll(few).count()


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").splitlines() if "/shuffle_" in f}


def test_shuffles_of_a_stored_step_are_dropped(spark):
    before = shuffle_files(spark)
    kept = tables.stored(spark.range(10_000).repartition(4, "id"), "rows")
    until = time.time() + 20  # files go in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and kept.count() == 10_000


def test_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name) == (before or "false")


def test_merge_moves_what_was_staged(spark, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    rows = spark.range(40).select("id", F.col("id").cast("int").alias("v"), (F.col("id") % 4).cast("int").alias("p"))
    tables.replace_table(rows, path, "p")
    untouched = sorted(p.name for p in (tmp_path / "t" / "p=0").iterdir())

    def copied(*_):
        raise AssertionError("the staged rows are written once more")

    monkeypatch.setattr(tables, "replace_partitions", copied)
    batch = spark.createDataFrame([(1, 100, 2), (5, 101, 1), (99, 102, 9)], "id bigint, v bigint, p int")
    assert sorted(tables.upsert_table(spark, path, staging, batch, "id", ["v", "p"], "p")) == [1, 2, 9]
    expected = {r.id: (r.v, r.p) for r in rows.collect()} | {1: (100, 2), 5: (101, 1), 99: (102, 9)}
    table = spark.read.parquet(path)
    assert {r.id: (r.v, r.p) for r in table.collect()} == expected and table.count() == 41
    assert table.schema["v"].dataType.simpleString() == "int"
    assert not list((tmp_path / "s").glob("p=*"))
    assert sorted(p.name for p in (tmp_path / "t" / "p=0").iterdir()) == untouched


def test_merge_copies_what_was_staged_in_another_file_system(spark, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    tables.replace_table(spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "id int, v int, p int"), path, "p")
    own = tables._folder_api

    class Elsewhere:
        def __init__(self, fs):
            self.listStatus = fs.listStatus

        def getUri(self):
            return spark.sparkContext._jvm.java.net.URI("elsewhere:///")

    def folder_api(session, folder):
        path_class, root, fs = own(session, folder)
        return path_class, root, Elsewhere(fs) if folder == staging else fs

    monkeypatch.setattr(tables, "_folder_api", folder_api)
    batch = spark.createDataFrame([(1, 10, 2), (3, 3, 3)], "id int, v int, p int")
    tables.upsert_table(spark, path, staging, batch, "id", ["v", "p"], "p")
    assert sorted((r.id, r.v, r.p) for r in spark.read.parquet(path).collect()) == [(1, 10, 2), (2, 2, 2), (3, 3, 3)]
    assert list((tmp_path / "s").glob("p=*"))


def test_merge_ships_only_the_columns_it_updates(spark):
    source = spark.createDataFrame([("a", 1, 2, "text")], "id string, v bigint, w bigint, name string")
    assert keys._one_per_key(source, "id", ["v", "w"]).schema["_new"].dataType.names == ["v", "w"]
    assert keys._one_per_key(source, "id", []).columns == ["_source_key", "_copies"]


def test_duplicates_are_removed_before_month_and_weekday_are_added(spark):
    target, source = loads._merge_sides(spark, SF_DIR)
    assert target.columns == source.columns == d.sales(spark, SF_DIR).columns
    for side, part in ((target, d.history), (source, d.arriving)):
        whole = keys.remove_duplicates(part(d.sales(spark, SF_DIR)), loads.KEY, "last", tie_break=loads.TIES)
        assert side.exceptAll(whole).count() == 0 == whole.exceptAll(side).count()


class Constant:
    def transform(self, rows):
        return rows.withColumn("prediction", F.lit(1.0))


def test_a_forecast_makes_the_features_once(spark, monkeypatch):
    made, own = [], features.feature_history
    monkeypatch.setattr(learning, "_fitted", {})
    monkeypatch.setattr(features, "feature_history", lambda cleaned: made.append(1) or own(cleaned))
    monkeypatch.setattr(learning.m, "fit_boosted", lambda split: learning._split(spark, SF_DIR) and Constant())
    alone = learning._split(spark, SF_DIR)
    learning._fitted.clear()
    made.clear()
    forecast = learning._forecast(spark, SF_DIR)
    split = learning._split(spark, SF_DIR)
    assert len(made) == 1
    assert not [f for df in (forecast, split) for f in df.inputFiles() if f.startswith(f"file://{SF_DIR}")]
    assert split.exceptAll(alone).count() == 0 == alone.exceptAll(split).count()
    whole = learning.m.sales_forecast(Constant(), own(d.cleaned(spark, SF_DIR)), d.AS_OF)
    assert forecast.exceptAll(whole).count() == 0 == whole.exceptAll(forecast).count() and whole.count() > 0


def test_the_refresh_forecasts_from_rows_that_lie_by_product(spark, tmp_path, monkeypatch):
    rows = [(f"p{i % 3}", f"n{i % 3}", "c", START + timedelta(days=7 * i), 60000.0 + i, None, i, 4.0, i) for i in range(30)]
    cleaned = spark.createDataFrame(
        rows,
        "product_id string, product_name string, category string, sale_date date, price double, discount_percent double, "
        "sales_count bigint, rating double, review_count bigint",
    )
    used = []

    class Seen(Exception):
        pass

    def forecast(model, history, as_of):
        used.append(history)
        raise Seen

    for name in ("fit_linear", "fit_boosted"):
        monkeypatch.setattr(model_store.m, name, lambda split: None)
    monkeypatch.setattr(model_store, "_keep", lambda model, *_: model)
    monkeypatch.setattr(model_store.m, "model_evaluation", lambda *_: spark.range(1))
    monkeypatch.setattr(model_store.m, "sales_forecast", forecast)
    dealt = cleaned.repartition("product_id", "sale_date")
    with pytest.raises(Seen):
        model_store.refresh_models(spark, cleaned, str(tmp_path / "w"), date(2024, 8, 1), by_product_day=dealt)
    expected = features.feature_history(cleaned)
    table = spark.read.parquet(str(tmp_path / "w" / "feature_history"))
    assert len({f.split("sale_month=")[1][:10] for f in table.inputFiles()}) > 3
    assert not [f for f in used[0].inputFiles() if "sale_month=" in f]
    for found in (used[0], table.drop("sale_month").select(*expected.columns)):
        assert found.exceptAll(expected).count() == 0 == expected.exceptAll(found).count()
