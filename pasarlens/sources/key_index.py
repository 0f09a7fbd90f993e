"""An append-only index of stored keys: buckets that grow in number with the keys, and Bloom filters that say which to read.

Keys are stored by generation, hash bucket and batch. A generation has twice as many buckets as the one before and takes keys until
its buckets are full on average; older keys stay where they are, so that nothing is ever rewritten and a key can be in as many
places as there are generations. Beside the keys are the words of a blocked Bloom filter: a key sets a few bits of one
64-bit word of its bucket. Words of several batches are merged by ``or``, now and then for good. A batch looks its keys up in the words,
and reads only the buckets in which one of them may be; only these keys are then compared.

Every batch writes its own folders and reads what the batch before has left, so that a replayed batch leads to the same index.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.operators.keys import append_new

#: Keys of a bucket on average when its generation is full, filter bits per key then, bits a key sets, batches between merges.
BUCKET_KEYS = 1 << 16
BITS_PER_KEY = 24
BITS_SET = 5
MERGE_EVERY = 16

WORDS = "bucket int, word int, bits bigint, depth int, batch_id bigint"
PROGRESS = "depth int, stored bigint, merged bigint, buckets bigint, touched bigint, candidates bigint, known bigint"


def _power(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent)


@dataclass(frozen=True)
class KeyIndex:
    """The index below ``root`` of the column ``key``, whose declared type is ``kind``."""

    spark: SparkSession
    root: str
    key: str
    kind: T.DataType
    bucket_keys: int = BUCKET_KEYS
    merge_every: int = MERGE_EVERY

    @property
    def words(self) -> int:
        """Filter words of a bucket."""
        return max(1, self.bucket_keys * BITS_PER_KEY // 64)

    def _bucket(self, depth: int) -> Column:
        return F.xxhash64(self.key).bitwiseAND(F.lit((1 << depth) - 1)).cast("int")

    def _word(self) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.words)).cast("int")

    def _mask(self) -> Column:
        drawn = F.xxhash64(self.key, F.lit(2))
        mask = F.lit(0).cast("bigint")
        for i in range(BITS_SET):
            mask = mask.bitwiseOR(_power(F.shiftrightunsigned(drawn, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
        return mask

    def progress(self, batch_id: int) -> dict:
        """What a batch has left; before the first one nothing is stored."""
        if batch_id < 0:
            return {"depth": 0, "stored": 0, "merged": -1}
        return self.spark.read.schema(PROGRESS).parquet(f"{self.root}/progress/batch_id={batch_id}").first().asDict()

    def _filter(self, batch_id: int, merged: int) -> DataFrame:
        """The words that batches before this one have written: the merged ones and those since."""
        since = [f"{self.root}/filter/batch_id={b}" for b in range(merged + 1, batch_id)]
        parts = [self.spark.read.schema(WORDS).option("basePath", f"{self.root}/filter").parquet(*since)] if since else []
        if merged >= 0:
            parts.append(self.spark.read.schema(WORDS).parquet(f"{self.root}/merged/upto={merged}"))
        columns = ["depth", "bucket", "word", "bits"]
        out = parts[0].select(columns)
        return out.unionByName(parts[1].select(columns)) if len(parts) > 1 else out

    def _candidates(self, keys: DataFrame, words: DataFrame) -> DataFrame:
        """The keys that may be stored, with the generation and bucket of each place. Generations that a large batch has skipped hold
        nothing and are not asked."""
        depths = sorted(r[0] for r in words.select("depth").distinct().collect()) or [0]
        asked = keys.select(
            self.key, self._word().alias("word"), self._mask().alias("mask"),
            F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), self._bucket(d).alias("bucket")) for d in depths])).alias("at"),
        ).select(self.key, "word", "mask", "at.*")
        same = [asked[c] == words[c] for c in ("depth", "bucket", "word")]
        hit = words["bits"].bitwiseAND(asked["mask"]) == asked["mask"]
        return asked.join(words, [*same, hit], "left_semi").select(self.key, "depth", "bucket")

    def _stored(self, depth: int) -> DataFrame:
        schema = T.StructType([
            T.StructField(self.key, self.kind), T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())
        ])
        return self.spark.read.schema(schema).parquet(f"{self.root}/keys/depth={depth}")

    def fresh(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, dict]:
        """The rows of a batch whose keys no earlier batch has stored, and figures of the look-up. The batch is read twice, its keys first."""
        last = self.progress(batch_id - 1)
        figures = {"buckets": 0, "touched": 0, "candidates": 0, "known": 0}
        if batch_id == 0:
            return batch, figures
        keys = batch.select(self.key).distinct()
        candidates = self._candidates(keys, self._filter(batch_id, last["merged"])).persist()
        try:
            # one row per bucket that is to be read
            touched = [tuple(r) for r in candidates.select("depth", "bucket").distinct().collect()]
            figures |= {
                "buckets": (1 << last["depth"] + 1) - 1, "touched": len(touched),
                "candidates": candidates.select(self.key).distinct().count(),
            }
            if not touched:
                return batch, figures
            maybe = candidates.select(F.col(self.key).alias("_key")).distinct()
            known = None
            for depth in sorted({d for d, _ in touched}):
                own = self._stored(depth).where(
                    F.col("bucket").isin([b for d, b in touched if d == depth]) & (F.col("batch_id") < batch_id)
                )
                same = own[self.key].eqNullSafe(maybe["_key"])
                found = own.join(maybe, same, "left_semi").select(self.key)
                known = found if known is None else known.unionByName(found)
            path = f"{self.root}/known/batch_id={batch_id}"
            known.distinct().write.mode("overwrite").parquet(path)
        finally:
            candidates.unpersist()
        known = self.spark.read.schema(T.StructType([T.StructField(self.key, self.kind)])).parquet(path)
        figures["known"] = known.count()
        return append_new(batch, known, self.key), figures

    def add(self, fresh: DataFrame, batch_id: int, figures: dict) -> None:
        """Store the keys of a batch's fresh rows, their filter words and what the next batch needs to know. Keys are gathered by bucket
        before they are written, so that a batch adds a few files to a bucket and not one of every task."""
        last = self.progress(batch_id - 1)
        keys = fresh.select(self.key).distinct().persist()
        try:
            count = keys.count()
            depth, stored = last["depth"], last["stored"]
            needed = ceil(log2(max(1, count / self.bucket_keys)))
            if stored >= self.bucket_keys << depth or needed > depth:
                # a full generation is followed by one of twice as many buckets; a large batch gets as many as it fills
                depth, stored = max(depth + (stored > 0), needed), 0
            placed = keys.select(self.key, self._bucket(depth).alias("bucket"), F.lit(batch_id).cast("bigint").alias("batch_id"))
            placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(
                f"{self.root}/keys/depth={depth}"
            )
            words = keys.groupBy(self._bucket(depth).alias("bucket"), self._word().alias("word")).agg(F.bit_or(self._mask()).alias("bits"))
            words.withColumn("depth", F.lit(depth)).write.mode("overwrite").parquet(f"{self.root}/filter/batch_id={batch_id}")
        finally:
            keys.unpersist()
        merged = last["merged"]
        if batch_id - merged >= self.merge_every:
            every = self._filter(batch_id + 1, merged).groupBy("depth", "bucket", "word").agg(F.bit_or("bits").alias("bits"))
            every.write.mode("overwrite").parquet(f"{self.root}/merged/upto={batch_id}")
            merged = batch_id
        row = {"depth": depth, "stored": stored + count, "merged": merged, **figures}
        progress = self.spark.createDataFrame([tuple(row[c.split()[0]] for c in PROGRESS.split(", "))], PROGRESS)
        progress.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/progress/batch_id={batch_id}")

    def report(self) -> DataFrame:
        """Per batch: buckets there are and buckets read, keys that passed the filter and keys that were known."""
        return self.spark.read.schema(PROGRESS + ", batch_id bigint").parquet(f"{self.root}/progress")
