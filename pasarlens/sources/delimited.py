"""CSV readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pasarlens.schemas import CATALOGUE

# 'yyyy-MM' month texts must not be taken for timestamps when types are inferred.
_STRICT_TIMES = {"dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Header CSV. Without a schema the types are inferred, at the price of a second pass over the text.

    ``multi_line`` allows line breaks inside quoted text; each file is then read by one task.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line, **_STRICT_TIMES)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CATALOGUE)


def write_csv(df: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> None:
    """Header CSV, quotes doubled; files stay small enough to be read whole when text holds line breaks."""
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', maxRecordsPerFile=max_records_per_file, **_STRICT_TIMES
    ).csv(path)


def load_csv(
    spark: SparkSession, source: str, target: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Replace the table with the file's rows and return the table."""
    loaded = read_csv(spark, source, schema, multi_line)
    loaded.write.mode("overwrite").parquet(target)
    return spark.read.schema(loaded.schema).parquet(target)
