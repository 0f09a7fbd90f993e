"""Tables clustered by several columns: rows along a space-filling curve, and the range of each file beside the table.

Sorting by one column and then another makes only the first one narrow in a file. Along a Z-order curve over the ranks of all
clustering columns each file is narrow in every one of them, so that a filter on any column leaves few files. Which files
these are is told by a small table of the files' smallest and largest values; the others are not even opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pasarlens.operators.ranks import numbered
from pasarlens.sources.tables import stored

#: Bits of a column's rank on the curve.
RANK_BITS = 12


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """The bits of all ranks in turn, as one whole number; at most 63 bits in all."""
    if len(ranks) * bits > 63:
        raise ValueError("too many columns for the bits of a rank")
    parts = []
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
            parts.append(F.shiftleft(one, bit * len(ranks) + i))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the rank of its value among the column's values, weighted by their rows and scaled to ``RANK_BITS``; nulls first.

    Ranks come from one row per value, so a value that many rows have is one short row; the rows get their rank by a join.
    """
    counts = stored(df.groupBy(column).agg(F.count("*").alias("_n")), "values")
    total = counts.agg(F.sum("_n")).first()[0] or 1
    placed = numbered(counts, [F.asc_nulls_first(column)], "_place")
    # rows before a value: within blocks of values, and in the blocks before
    block = F.shiftright("_place", 12)
    blocks = placed.groupBy(block.alias("_block")).agg(F.sum("_n").alias("_sum"))
    before = _running(blocks, "_sum", [], "_block").select("_block", F.col("_before").alias("_start"))
    within = _running(placed.withColumn("_block", block), "_n", ["_block"], "_place").join(before, "_block")
    # the middle of a value's rows; frequent values so take as much of the curve as they have rows
    share = (F.col("_start") + F.col("_before") + F.col("_n") / 2) / F.lit(float(total))
    rank = F.least(F.floor(share * (1 << RANK_BITS)), F.lit((1 << RANK_BITS) - 1))
    ranks = stored(within.select(F.col(column).alias("_value"), rank.alias(name)), "ranks")
    return df.join(ranks, df[column].eqNullSafe(ranks["_value"])).drop("_value")


def _running(df: DataFrame, value: str, within: list[str], order: str) -> DataFrame:
    window = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))).orderBy(order)
    return df.withColumn("_before", F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Replace a table by rows in about ``files`` files along the curve, and store each file's ranges in ``path``_ranges."""
    spark = df.sparkSession
    ranked, names = df, [f"_rank_{i}" for i in range(len(columns))]
    for column, name in zip(columns, names, strict=True):
        ranked = _ranked(ranked, column, name)
    placed = ranked.withColumn("_curve", interleaved([F.col(n).cast("bigint") for n in names])).drop(*names)
    # rows of one place on the curve are spread by a hash, so that a frequent pair of values does not fall into one task
    spread = F.xxhash64(*df.columns)
    ordered = placed.repartitionByRange(files, "_curve", spread).sortWithinPartitions("_curve").drop("_curve")
    ordered.write.mode("overwrite").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    ranges = [f for c in columns for f in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))]
    per_file = written.select(F.col("_metadata.file_path").alias("file"), *columns).groupBy("file").agg(*ranges)
    per_file.write.mode("overwrite").parquet(f"{path}_ranges")


def matching_files(spark: SparkSession, path: str, wanted: dict[str, object]) -> list[str]:
    """The files that may hold rows with these values (null included); one name per file that is to be read."""
    may = [
        F.col(f"nulls_{c}") > 0 if v is None else F.lit(v).between(F.col(f"min_{c}"), F.col(f"max_{c}")) for c, v in wanted.items()
    ]
    ranges = spark.read.parquet(f"{path}_ranges")
    return [r["file"] for r in ranges.where(reduce(lambda a, b: a & b, may)).select("file").collect()]


def read_clustered(spark: SparkSession, path: str, wanted: dict[str, object]) -> DataFrame:
    """The rows of a clustered table with these values, from the files that may hold them."""
    files = matching_files(spark, path, wanted)
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in wanted.items()]))
