"""Key-based loading: append only new keys, upsert, find and remove duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _known_keys(target: DataFrame, key: str) -> DataFrame:
    """The target's keys, one row each, so that the join never multiplies rows and a hot target key is one row."""
    return target.select(F.col(key).alias("_known_key")).distinct()


def _same_key(batch: DataFrame, keys: DataFrame, key: str) -> Column:
    """Null equals null here: a null key already in the target counts as known."""
    return batch[key].eqNullSafe(keys["_known_key"])


def append_new(batch: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Rows of the batch whose key the target does not have yet.

    Copies inside the batch are all kept. Without a target, or without the key column, every row is new.
    """
    if target is None or key not in batch.columns:
        return batch
    keys = _known_keys(target, key)
    return batch.join(keys, _same_key(batch, keys, key), "left_anti")


def append_new_stats(batch: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """One row: total_input, duplicates_skipped, new_records, status."""
    if target is None or key not in batch.columns:
        flagged = batch.select(F.lit(False).alias("known"))
    else:
        keys = _known_keys(target, key).withColumn("known", F.lit(True))
        flagged = batch.select(key).join(keys, _same_key(batch, keys, key), "left").select("known")
    total, known = F.count("*"), F.count_if(F.coalesce("known", F.lit(False)))
    return flagged.agg(
        total.alias("total_input"),
        known.alias("duplicates_skipped"),
        (total - known).alias("new_records"),
        F.lit("success").alias("status"),
    )


def _one_per_key(source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Source rows reduced to one per key, with the number of rows behind it and those of the columns that are to be used; null keys match
    nothing. Where a key has several rows, their number tells so, and the values are not used."""
    payload = [c for c in source.columns if c in columns and c != key]
    new = [F.max(F.struct(*payload)).alias("_new")] if payload else []
    return (
        source.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_source_key"))
        .agg(F.count("*").alias("_copies"), *new)
    )


def _not_in(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    keys = _known_keys(target, key)
    return source.join(keys, source[key] == keys["_known_key"], "left_anti")


def upsert(target: DataFrame, source: DataFrame, key: str, update_columns: Sequence[str] = ()) -> DataFrame:
    """Target after a merge: matched rows take the listed columns, unmatched source rows are inserted whole.

    A target row matched by several source rows fails the query, as a SQL MERGE does. The source is reduced to
    one row per key before the join, so the join cannot multiply rows; a hot target key is left to skew
    splitting, which works for the left and anti joins used here but would not for a full outer join.
    """
    matches = _one_per_key(source, key, update_columns)
    joined = target.join(matches, target[key] == matches["_source_key"], "left")
    ambiguous = F.raise_error(F.lit(f"several source rows match one target row on {key}")).cast("boolean")
    checked = joined.where(F.when(F.col("_copies") > 1, ambiguous).otherwise(True))
    matched = F.col("_copies").isNotNull()
    updated = checked.select(
        *[
            F.when(matched, F.col("_new")[c]).otherwise(target[c]).alias(c) if c in update_columns else target[c]
            for c in target.columns
        ]
    )
    return updated.unionByName(_not_in(source, target, key))


def upsert_stats(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: rows_updated, rows_inserted and their sum rows_affected."""
    matches = source.where(F.col(key).isNotNull()).select(F.col(key).alias("_known_key")).distinct()
    updated = target.join(matches, target[key] == matches["_known_key"], "left_semi")
    inserted = _not_in(source, target, key)
    counts = updated.select(F.lit("u").alias("kind")).unionByName(inserted.select(F.lit("i").alias("kind")))
    rows_updated, rows_inserted = (F.count_if(F.col("kind") == k) for k in ("u", "i"))
    return counts.agg(
        rows_updated.alias("rows_updated"),
        rows_inserted.alias("rows_inserted"),
        (rows_updated + rows_inserted).alias("rows_affected"),
    )


def remove_duplicates(
    df: DataFrame, key: str, keep: str = "first", order_by: str = "ingestion_date", tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the earliest (``first``) or latest (``last``) by ``order_by``.

    Equal dates are ordered by ``tie_break`` and then by every other column, so reruns keep the same row. The
    rank filter is pushed below the shuffle (WindowGroupLimit), so each task ships at most one row per key.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in (*tie_break, *df.columns) if c not in (key, order_by)]
    when = F.asc_nulls_first(order_by) if keep == "first" else F.desc_nulls_last(order_by)
    ranked = W.partitionBy(key).orderBy(when, *[F.asc_nulls_first(c) for c in dict.fromkeys(rest)])
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def check_duplicates(df: DataFrame, key: str, limit: int = 100) -> DataFrame:
    """The keys with most copies, at most ``limit`` of them."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("count"))
        .where(F.col("count") > 1)
        .orderBy(F.desc("count"), F.asc_nulls_first(key))
        .limit(limit)
    )
