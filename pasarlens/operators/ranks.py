"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.session import fresh_path

_FIRST_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with each row's number in the given order, from 0; the order must leave no ties, or these get any order.

    Rows are dealt out by range and sorted in each range; the sorted rows are stored with their number in the range, so that later
    jobs see the same ranges. A row's number is that plus the rows in the ranges before; only one count per range meets in a task.
    """
    path = fresh_path(df.sparkSession, "numbered")
    # the upper bits of the id are the range, the lower ones the place in it
    sorted_rows = df.orderBy(*order).withColumn(f"_{name}", F.monotonically_increasing_id())
    sorted_rows.write.parquet(path)
    rows = df.sparkSession.read.schema(sorted_rows.schema).parquet(path)
    part = F.shiftright(f"_{name}", _FIRST_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    starts = counts.select("_part", before.alias("_start"))
    place = F.col(f"_{name}").bitwiseAND(F.lit((1 << _FIRST_BITS) - 1)) + F.col("_start")
    return rows.join(starts, part == F.col("_part")).select(*df.columns, place.alias(name))
