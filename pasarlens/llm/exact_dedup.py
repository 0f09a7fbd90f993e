"""Exact duplicates by a heavy-hitter split.

Every text is known by its SHA-256. Misra-Gries counters in each task find the digests that may stand in a large share of all
rows; their counts are then verified exactly, and these winners, few by construction, are broadcast, so that their rows get
their result where they are. Only the other rows are shuffled by digest: none of their groups holds more than ``1 / SHARE`` of all rows.

Results in special cases: a null text counts as empty; a null id is smaller than every other; where the row that stays has an
equal row (same id and text), one of them stays; an empty table gives no rows. Texts of any length are digested whole;
other columns are neither read nor kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.scratch import stored

#: Digests that stand in more than one of so many rows are surely found by the counters.
SHARE = 4096
#: Counters a task holds. A task, and so the sum over all tasks, misses at most ``rows / (COUNTERS + 1)`` of a digest's rows.
COUNTERS = 2 * SHARE

_SIZE = 32


def text_digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


def count_batch(held: np.ndarray, counts: np.ndarray, digests: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Misra-Gries counters after a batch: equal digests are counted together; of more than ``most`` counters all lose the
    value of the largest one that is too many, and those that reach zero go."""
    together = np.concatenate([held, digests])
    weights = np.concatenate([counts, np.ones(len(digests), np.int64)])
    keys, place = np.unique(together, return_inverse=True)
    sums = np.bincount(place, weights=weights, minlength=len(keys)).astype(np.int64)
    if len(keys) > most:
        sums -= np.partition(sums, len(sums) - most - 1)[len(sums) - most - 1]
        keys, sums = keys[sums > 0], sums[sums > 0]
    return keys, sums


def misra_gries(digests: DataFrame, most: int = COUNTERS) -> DataFrame:
    """Counters of each task (``digest``, ``counted``) and, with a null digest, the number of its rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, rows = np.zeros(0, f"V{_SIZE}"), np.zeros(0, np.int64), 0
        for batch in batches:
            column = batch.column(0).cast(pa.binary(_SIZE))
            if not len(column):
                continue
            raw = np.frombuffer(column.buffers()[1], f"V{_SIZE}")[column.offset : column.offset + len(column)]
            held, counts = count_batch(held, counts, raw, most)
            rows += len(raw)
        yield pa.RecordBatch.from_pydict(
            {"digest": [None, *(k.tobytes() for k in held)], "counted": [rows, *counts.tolist()]},
            schema=pa.schema([("digest", pa.binary()), ("counted", pa.int64())]),
        )

    return digests.select("digest").mapInArrow(count, "digest binary, counted long")


def frequent(digests: DataFrame, share: int = SHARE) -> DataFrame:
    """Digests that may stand in more than a ``share``-th of all rows; fewer than ``2 * share + 1``.

    Summed over all tasks the counters miss at most ``rows / (2 * share + 1)`` of a digest's rows, so that every such digest
    still has the bound below; and as the sums of all digests are at most the number of rows, few can have it.
    """
    counters = stored(misra_gries(digests, 2 * share).groupBy("digest").agg(F.sum("counted").alias("counted")), "counters")
    rows = counters.where("digest IS NULL").first()
    least = max(2.0, rows["counted"] / share - rows["counted"] / (2 * share + 1)) if rows else 2.0
    return counters.where(F.col("digest").isNotNull() & (F.col("counted") >= least)).select("digest")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, digest and a number of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("digest"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def _stays() -> Column:
    """The row of the largest id, of equal ones the last."""
    return F.max(F.struct("doc_id", "row"))


def _winners(rows: DataFrame, share: int) -> DataFrame:
    """Exact size and staying row of each frequent digest."""
    verified = rows.join(F.broadcast(frequent(rows, share)), "digest")
    return stored(verified.groupBy("digest").agg(_stays().alias("stays"), F.count("*").alias("group_size")), "winners")


def _judged(rows: DataFrame, winners: DataFrame) -> DataFrame:
    marked = rows.join(F.broadcast(winners), "digest", "left")
    group = Window.partitionBy("digest")
    rest = marked.where("stays IS NULL").select(
        "digest", "doc_id", "row", _stays().over(group).alias("stays"), F.count("*").over(group).alias("group_size")
    )
    return marked.where("stays IS NOT NULL").select(rest.columns).unionByName(rest)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row."""
    rows = _rows(docs, doc_id, text)
    return _judged(rows, _winners(rows, share)).select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def remove_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """The rows that stay, with all their columns; of equal ones (same id and text) any one. Copies of frequent texts go before
    texts are shuffled."""
    rows = _rows(docs, doc_id, text)
    winners = _winners(rows, share)
    stays = _judged(rows, winners).where("row = stays.row").select("digest", F.col("doc_id").alias("stays_id"))
    hot = F.broadcast(winners.select("digest", F.col("stays.doc_id").alias("hot_id"), F.lit(True).alias("hot")))
    whole = docs.select(F.struct(*docs.columns).alias("whole"), F.col(doc_id).alias("id"), text_digest(text).alias("digest"))
    left = whole.join(hot, "digest", "left").where(F.col("hot").isNull() | F.col("id").eqNullSafe(F.col("hot_id")))
    same = (F.col("a.digest") == F.col("b.digest")) & F.col("a.id").eqNullSafe(F.col("b.stays_id"))
    return left.alias("a").join(stays.alias("b"), same, "left_semi").dropDuplicates(["digest"]).select("whole.*")
