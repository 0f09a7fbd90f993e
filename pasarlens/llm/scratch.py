"""Tables written on the way, in the shared folder; a written table cuts lineage and survives lost executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.session import fresh_path


#: Texts in an Arrow batch; Spark's own default is 10,000 rows, which long texts make tens of megabytes in the executor
#: and again in its Python worker.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches fit long texts, unless the user has chosen a size."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def reduced(df: DataFrame, key: str | list[str], *values: Column) -> DataFrame:
    """Aggregates by a key, the first column of it a whole number, to be joined back to the rows.

    The second grouping expression says nothing new, but it makes the join deal the result out again. Only where both sides of a
    join come straight from an exchange can adaptive execution split the rows of a frequent key over many tasks.
    """
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys, F.shiftright(keys[0], 1).alias("_half")).agg(*values).drop("_half")


def stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
