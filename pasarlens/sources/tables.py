"""Date-partitioned Parquet tables: layout, append, replace, partial rewrite, expiry and backup."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.operators.keys import upsert
from pasarlens.session import fresh_path, shuffles_dropped


def stamp_ingestion(df: DataFrame, as_of: date) -> DataFrame:
    return df.withColumn("ingestion_date", F.lit(as_of))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a declared table, in order and typed; absent optional columns become null.

    Unreadable values raise, as a load into a typed table does. Nulls in required columns are data and are counted
    by ``quality.required_rules``.
    """
    absent = [field.name for field in schema if field.name not in df.columns and not field.nullable]
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    return df.select(
        *[
            (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )


def _laid_out(df: DataFrame, partition: str | None, cluster: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value and sorted by the cluster columns inside each file.

    The rebalance hint lets adaptive execution split a hot day over many tasks and merge small days into one;
    the sort gives narrow min/max statistics per row group, which is what clustering is for.
    """
    if partition is None:
        return df
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def write_table(
    df: DataFrame, path: str, mode: str = "append", partition: str | None = None, cluster: Sequence[str] = ()
) -> None:
    writer = _laid_out(df, partition, cluster).write.mode(mode)
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(partition) if partition else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()) -> None:
    write_table(df, path, "append", partition, cluster)


def replace_table(df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()) -> None:
    write_table(df, path, "overwrite", partition, cluster)


def replace_partitions(df: DataFrame, path: str, partition: str, cluster: Sequence[str] = ()) -> None:
    """Replace only the partitions the rows fall into; running it again gives the same table."""
    laid_out = _laid_out(df, partition, cluster)
    with shuffles_dropped(df.sparkSession):
        laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def rewrite_table(
    spark: SparkSession,
    path: str,
    staging: str,
    change: Callable[[DataFrame], DataFrame],
    partition: str | None = None,
) -> None:
    """Replace a table by a query over itself.

    Spark refuses to overwrite a path it is reading, so the result is stored in ``staging`` first; if the job
    is lost while the table is being replaced, the whole result is still there.
    """
    before = spark.read.parquet(path)
    replace_table(change(before), staging, partition)
    replace_table(spark.read.schema(before.schema).parquet(staging), path, partition)


def _folder_api(spark: SparkSession, path: str):
    """Hadoop path class, root path and file system: Spark has no DataFrame call to list or drop a folder."""
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = path_class(path)
    return path_class, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str, partition: str) -> dict[str, object]:
    """Partition values of a table as text, each with its folder, from one listing: no file is opened.

    Spark escapes characters that a folder name cannot hold as ``%XX``; the values here are unescaped.
    """
    _, root, fs = _folder_api(spark, path)
    listed = [status.getPath() for status in fs.listStatus(root)]
    prefix = f"{partition}="
    return {unquote(p.getName()[len(prefix) :]): p for p in listed if p.getName().startswith(prefix)}


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a fresh folder and read back: cut lineage, and a size that the optimizer knows."""
    path = fresh_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def waiting_files(spark: SparkSession, path: str) -> list[object]:
    """The files and folders directly below a landing folder that are not marked as unfinished; none if it is missing."""
    _, root, fs = _folder_api(spark, path)
    if not fs.exists(root):
        return []
    found = [status.getPath() for status in fs.listStatus(root)]
    return [p for p in found if not p.getName().startswith(("_", "."))]


def archive_files(spark: SparkSession, files: Iterable[object], archive: str) -> None:
    """Move landed files to the archive folder, by name only; a name that is taken there is an error."""
    path_class, root, fs = _folder_api(spark, archive)
    fs.mkdirs(root)
    for file in files:
        if not fs.rename(file, path_class(root, file.getName())):
            raise OSError(f"cannot archive {file}")


def _drop_folders(spark: SparkSession, path: str, folders: Iterable[object]) -> None:
    _, _, fs = _folder_api(spark, path)
    for folder in folders:
        fs.delete(folder, True)


def _touched_values(df: DataFrame, partition: str) -> list[object]:
    """Distinct partition values of a batch; the list is bounded by the number of partition folders."""
    return [row[0] for row in df.select(partition).distinct().collect()]


def _put_in_place(spark: SparkSession, staging: str, path: str, partition: str) -> set[str]:
    """Move the folders of a staged table to where the table has them; returns their partition values.

    The rows were gathered and sorted when they were staged, so that a copy would shuffle and write all of them once more. It is made
    only where staging and table lie in different file systems, between which no folder can be moved.
    """
    staged, present = _folders(spark, staging, partition), _folders(spark, path, partition)
    (_, _, from_fs), (path_class, root, fs) = _folder_api(spark, staging), _folder_api(spark, path)
    if from_fs.getUri().toString() != fs.getUri().toString():
        replace_partitions(spark.read.schema(spark.read.parquet(path).schema).parquet(staging), path, partition)
        return set(staged)
    for value, folder in staged.items():
        _drop_folders(spark, path, [present[value]] if value in present else [])
        if not fs.rename(folder, path_class(root, folder.getName())):
            raise OSError(f"cannot move {folder} to {path}")
    spark.catalog.refreshByPath(path)
    return set(staged)


def upsert_table(
    spark: SparkSession,
    path: str,
    staging: str,
    source: DataFrame,
    key: str,
    update_columns: Sequence[str],
    partition: str,
) -> list[object]:
    """Merge a batch into a partitioned table, rewriting only the partitions it touches.

    A partition is touched if it holds a matched row or receives a row. Rows that move to another partition
    leave the old one; a partition that ends up empty is removed. Partition values are texts, dates or whole numbers. The batch is
    stored first, because it is read several times, and so are the merged rows, so that the shuffles by key are gone when those by
    partition begin. The merged partitions are whole in ``staging`` before one of the table is touched.
    """
    source = stored(source, "batch")
    table = spark.read.parquet(path)
    keys = source.where(F.col(key).isNotNull()).select(key).distinct()
    matched = table.join(keys, key, "left_semi").select(partition)
    touched = _touched_values(matched.unionByName(source.select(partition)), partition)
    if not touched:
        return []
    if None in touched:
        raise ValueError(f"{partition} must not be null: it decides where a row is stored")
    merged = stored(upsert(table.where(F.col(partition).isin(touched)), source, key, update_columns), "merged")
    write_table(merged.select(*[F.col(f.name).cast(f.dataType) for f in table.schema]), staging, "overwrite", partition)
    filled = _put_in_place(spark, staging, path, partition)
    present = _folders(spark, path, partition)
    emptied = {str(value) for value in touched} - filled
    _drop_folders(spark, path, [present[value] for value in sorted(emptied) if value in present])
    return touched


def unexpired(df: DataFrame, day: str, keep_days: int, as_of: date) -> DataFrame:
    """Rows not older than ``keep_days`` before ``as_of``."""
    return df.where(F.col(day) >= F.date_sub(F.lit(as_of), keep_days))


def expire_partitions(spark: SparkSession, path: str, day: str, keep_days: int, as_of: date) -> int:
    """Remove the day folders older than the limit; returns how many. No file is read."""
    cutoff = (as_of - timedelta(days=keep_days)).isoformat()
    old = [folder for value, folder in _folders(spark, path, day).items() if value[:1].isdigit() and value < cutoff]
    _drop_folders(spark, path, old)
    return len(old)


#: Records of a file of compressed text, which one task reads.
TEXT_RECORDS = 1_000_000


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", partition: str | None = None) -> None:
    """Newline-delimited JSON, compressed, in files of bounded size: as plain text it is many times the size of the rows."""
    writer = df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", TEXT_RECORDS)
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(partition) if partition else writer).json(path)


def backup_tables(tables: dict[str, DataFrame], root: str, stamp: str) -> dict[str, int]:
    """Export each table as compressed newline-delimited JSON below ``root/stamp/table``; rows per table, counted while written."""
    rows = {}
    for name, df in tables.items():
        seen = Observation()
        write_json(df.observe(seen, F.count("*").alias("rows")), f"{root}/{stamp}/{name}")
        rows[name] = seen.get["rows"]
    return rows


def backup_report(
    spark: SparkSession, rows: dict[str, int], schemas: dict[str, T.StructType], root: str, stamp: str
) -> DataFrame:
    """Rows per table as exported, beside the rows read back from its export."""

    def counts(name: str) -> DataFrame:
        exported = spark.read.schema(schemas[name]).json(f"{root}/{stamp}/{name}")
        return exported.agg(
            F.lit(name).alias("table_name"),
            F.lit(rows[name]).cast("bigint").alias("live_rows"),
            F.count("*").alias("exported_rows"),
        )

    return reduce(DataFrame.unionByName, [counts(name) for name in rows])
