"""Substring dedup by De Bruijn compaction: long repeated spans keep the copy in the smallest id.

Windows of ``WINDOW`` words are the edges of a De Bruijn graph over words. Consecutive edges with the same minimizer (the ``ANCHOR``-word gram
of smallest hash in the window) form a path; equal windows always have equal minimizers, so paths meet only where minimizers do.

1. Minimizers that occur once are found cheaply: each task sends packed 32-bit hashes by bucket, and those counted twice or more set bits
   of a table. Buckets grow with the text, bits with the repeated minimizers. The table lets through every repeated minimizer and few others; frequent ones
   have a second bit. It is broadcast if its counted rows are few, and else joined over a shuffle that adaptive execution can split.
2. The remaining paths meet at their minimizer. Where all of them are equal the path does not branch, and the smallest id
   among its source coordinates decides for all its edges at once: these paths stay compact.
3. Paths that branch are taken apart: their edges are read again from the source text at their coordinates and are reduced to
   one row per edge, which is joined back.
4. Covered spans are joined to their text and cut out.

Minimizers met up to ``FREQUENT`` times are compared in windows over one shuffle, so a group is bounded; frequent ones are first
reduced to one row each, and joined back, so that no key's rows meet in one task. Two paths count as equal when minimizer and
content agree, two edges of branching paths when two hashes of their words do: polynomials modulo a prime of 61 bits, at two independent
points. Words themselves are not compared.

Results in special cases: a null text has no words; rows with a null id take no part and are returned whole; rows that share an id count as
one document, each with its own result; windows repeated within one document only are kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.scratch import bounded_batches, reduced, stored
from pasarlens.llm.text_arrays import (
    SPACED,
    Words,
    find_words,
    mix,
    packed_texts,
    pieces,
    range_hashes,
    unpacked_pieces,
    window_hashes,
    window_places,
)

WINDOW = 13
ANCHOR = 5
#: Occurrences up to which a minimizer's paths are compared in one group.
FREQUENT = 1000
#: Repeated minimizers for each word of 64 bits in their table, at most, so that a sixteenth of the bits is set at any size; and the
#: fewest words.
REPEATED_A_WORD = 4
LEAST_WORDS = 1 << 20
#: Rows of that table up to which it is broadcast (about 80 MB); a longer one is joined over a shuffle.
BROADCAST_ROWS = 1 << 20
#: Text bytes for each bucket of packed hashes, and the fewest buckets.
BUCKET_BYTES = 1 << 24
LEAST_BUCKETS = 64
_STEP = 1 << 15


def _paths(words: Words) -> tuple[np.ndarray, ...]:
    """Text, first window (word index in all texts), number of windows and minimizer place of each path."""
    whole = window_places(words.offsets, WINDOW)
    at = np.flatnonzero(whole)
    if not len(at):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    grams = window_hashes(words.hashes, ANCHOR)
    views = sliding_window_view(grams, WINDOW - ANCHOR + 1)
    place = np.concatenate([at[i : i + _STEP] + views[at[i : i + _STEP]].argmin(1) for i in range(0, len(at), _STEP)])
    row = words.row[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return row[first], at[first], count, place[first], grams[place[first]]


def _bucket(minimizer: np.ndarray, buckets: int) -> np.ndarray:
    return ((minimizer >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _presence(buckets: int):
    """For each batch and bucket: the low halves of its distinct minimizers, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_paths(find_words(data, o, SPACED))[4] for _, _, data, o in pieces(batch.column(0))]
            distinct, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            bucket = _bucket(distinct, buckets)
            order = np.argsort(bucket, kind="stable")
            own, starts = np.unique(bucket[order], return_index=True)
            ends = pa.array(np.append(starts, len(order)).astype(np.int32))
            keys = pa.array(distinct[order].astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own, pa.int32()),
                    pa.ListArray.from_arrays(ends, keys),
                    pa.ListArray.from_arrays(ends, pa.array(times[order].astype(np.int32))),
                ],
                ["bucket", "keys", "times"],
            )

    return run


def _emit_paths(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offsets in pieces(batch.column(2)):
                words = find_words(data, offsets, SPACED)
                row, at, count, place, minimizer = _paths(words)
                content = range_hashes(words.hashes, at, at + count + WINDOW - 1, point=1)
                content = mix(content ^ mix(((place - at) * 64 + count).astype(np.uint64)))
                who = pa.array(a + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(minimizer.view(np.int64)),
                        batch.column(0).take(who),
                        batch.column(1).take(who),
                        pa.array((at - words.offsets[row]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(content.view(np.int64)),
                        pa.array(_bucket(minimizer, buckets)),
                        pa.array(minimizer.astype(np.uint32).view(np.int32)),
                    ],
                    ["minimizer", "doc_id", "copy", "start", "count", "content", "bucket", "key"],
                )

    return run


def _position(table_words: int):
    """Of a minimizer in the table of bits: word, and bit of the word."""
    place = F.xxhash64("bucket", "key")
    return F.pmod(place, F.lit(table_words)).alias("word"), F.shiftrightunsigned(place, 58).cast("int").alias("bit")


def _one(bit: str):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(bit))


def _bucket_count(text_bytes: int) -> int:
    """Buckets of hashes for a corpus of this many bytes: a task's share does not grow with it."""
    return max(LEAST_BUCKETS, text_bytes // BUCKET_BYTES)


def _table_words(repeated: int) -> int:
    """Words of the table for this many minimizers, a power of two."""
    return max(LEAST_WORDS, 1 << (max(0, repeated - 1) // REPEATED_A_WORD).bit_length())


def _repeated_table(texts: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """The table of repeated minimizers, and the number of words that it is spread over."""
    packed = texts.select("text").mapInArrow(_presence(buckets), "bucket int, keys array<int>, times array<int>")
    each = packed.repartition("bucket").select("bucket", F.explode(F.arrays_zip("keys", "times")).alias("x"))
    counted = each.groupBy("bucket", F.col("x.keys").alias("key")).agg(F.sum("x.times").alias("n")).where("n > 1")
    counted = stored(counted.select("bucket", "key", (F.col("n") > FREQUENT).alias("often")), "repeated_minimizers")
    table_words = _table_words(counted.count())
    bits = counted.select("often", *_position(table_words))
    table = bits.groupBy("word").agg(
        F.bit_or(_one("bit")).alias("repeated"), F.bit_or(F.when(F.col("often"), _one("bit")).otherwise(0)).alias("frequent")
    )
    return stored(table, "minimizer_table"), table_words


def _met(rows: DataFrame, key: str, values: list) -> DataFrame:
    """Rows with aggregates over those of equal key: a window where the key is rare, one row per key joined back where
    it is not."""
    window = Window.partitionBy(key)
    rare = rows.where("NOT frequent").select("*", *[f(c).over(window).alias(name) for name, f, c in values])
    often = rows.where("frequent")
    by_key = reduced(often, key, *[f(c).alias(name) for name, f, c in values])
    return rare.unionByName(often.join(by_key, key))


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single edges of paths that branch, hashed from the text at their coordinates."""
    for batch in batches:
        paths = batch.column(3)
        for a, b, data, offsets in unpacked_pieces(batch.column(2)):
            words = find_words(data, offsets, SPACED)
            edges = window_hashes(words.hashes, WINDOW)
            again = window_hashes(find_words(data, offsets, SPACED, point=1).hashes, WINDOW, point=1)
            own = paths.slice(a, b - a)
            packed = own.flatten().to_numpy()
            row = np.repeat(np.arange(b - a), own.value_lengths().to_numpy())
            count = packed & 31
            row = np.repeat(row, count)
            start = np.repeat(packed >> 5, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            who = pa.array(a + row)
            place = words.offsets[row] + start
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(edges[place].view(np.int64)),
                    pa.array(again[place].view(np.int64)),
                    batch.column(0).take(who),
                    batch.column(1).take(who),
                    pa.array(start.astype(np.int32)),
                ],
                ["edge", "edge_again", "doc_id", "copy", "start"],
            )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text compressed, other columns as they are."""
    for batch in batches:
        yield batch.set_column(2, "packed", packed_texts(batch.column(2)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay joined by single spaces, and the text without the covered words and what follows each."""
    for batch in batches:
        spans = batch.column(2).fill_null(pa.scalar([], batch.column(2).type))
        for a, b, data, offsets in unpacked_pieces(batch.column(1)):
            words = find_words(data, offsets, SPACED, hashed=False)
            own = spans.slice(a, b - a)
            packed = own.flatten().to_numpy()
            row = np.repeat(np.arange(b - a), own.value_lengths().to_numpy())
            first = words.offsets[row] + (packed >> 5)
            steps = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(steps, first, 1)
            np.add.at(steps, first + (packed & 31) + WINDOW - 1, -1)
            covered = np.cumsum(steps[:-1]) > 0
            gone = np.zeros(len(data) + 1, np.int64)
            follow = np.minimum(np.append(words.starts[1:], len(data)), offsets[words.row + 1])
            np.add.at(gone, words.starts[covered], 1)
            np.add.at(gone, follow[covered], -1)
            stay = np.cumsum(gone[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(stay)])[offsets]
            text = data[stay]
            inside = SPACED[data] & stay
            # every kept word, and one blank after each but a text's last
            kept_words = np.flatnonzero(~covered)
            sizes = (words.ends - words.starts)[kept_words]
            last = np.append(words.row[kept_words][1:] != words.row[kept_words][:-1], True) if len(kept_words) else np.zeros(0, bool)
            stops = np.cumsum(sizes + ~last)
            joined = np.full(stops[-1] if len(stops) else 0, 0x20, np.uint8)
            at = np.repeat(stops - (sizes + ~last) - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            joined[at] = data[inside]
            bounds = np.append(0, stops)[np.searchsorted(words.row[kept_words], np.arange(b - a + 1))]
            removed = np.add.reduceat(np.append(covered, False).astype(np.int64), words.offsets[:-1]) if b > a else covered
            removed = np.where(np.diff(words.offsets) > 0, removed, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array(np.diff(words.offsets)),
                    pa.array(removed),
                    _strings(joined, bounds),
                    _strings(text, left),
                    *[column.slice(a, b - a) for column in batch.columns[3:]],
                ],
                ["doc_id", "n_words", "n_removed", "kept", "text", *batch.schema.names[3:]],
            )


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, buffers)


def _keyed(df: DataFrame, id_col: str, text_col: str, carry: bool) -> tuple[DataFrame, bool]:
    """Id, ``copy`` (0, or a hash of the text where several rows share the id) and text; the whole row too, if asked for. Second result:
    whether rows share an id."""
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.struct(*[c for c in df.columns if c != text_col]).alias("rest")] * carry,
    )
    more = ["rest"] * carry
    shared = reduced(rows.where("doc_id IS NOT NULL"), "doc_id", F.count("*").alias("n")).where("n > 1").select("doc_id")
    if shared.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("copy"), "text", *more), False
    marked = rows.join(shared.withColumn("shared", F.lit(True)), "doc_id", "left")
    copy = F.when(F.col("shared"), F.xxhash64("text")).otherwise(0).cast("long").alias("copy")
    return marked.select("doc_id", copy, "text", *more), True


def _listed(spans: DataFrame, name: str, shared: bool) -> DataFrame:
    """The spans of each text. Repeated rows of one id and text have the same spans, which count once; the lists are then dealt out
    again (as in ``reduced``), so that the join with such rows can be split."""
    if not shared:
        return spans.groupBy("doc_id", "copy").agg(F.collect_list("span").alias(name))
    once = spans.select("doc_id", "copy", "span").distinct()
    half = F.shiftright("doc_id", 1).alias("_half")
    return once.groupBy("doc_id", "copy", half).agg(F.collect_list("span").alias(name)).drop("_half")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per text: ``n_words``, ``n_removed``, the words that stay joined by one space (``kept``), and the text without the
    others (``text``). With ``carry``, also the row's other columns, as the struct ``rest``."""
    bounded_batches(df.sparkSession)
    texts, shared_ids = _keyed(df, id_col, text_col, carry)
    usable = texts.where("doc_id IS NOT NULL AND text IS NOT NULL")
    size = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = _bucket_count(int(size))
    table, table_words = _repeated_table(usable, buckets)
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)

    paths = usable.mapInArrow(
        _emit_paths(buckets),
        "minimizer bigint, doc_id bigint, copy bigint, start int, count int, content bigint, bucket int, key int",
    )
    word, bit = _position(table_words)
    open_ = stored(
        paths.select("minimizer", "doc_id", "copy", "start", "count", "content", word, bit)
        .join(table, "word")
        .where(F.col("repeated").bitwiseAND(_one("bit")) != 0)
        .withColumn("frequent", F.col("frequent").bitwiseAND(_one("bit")) != 0)
        .drop("word", "bit", "repeated"),
        "open_paths",
    )
    met = _met(
        open_,
        "minimizer",
        [("first", F.min, "doc_id"), ("last", F.max, "doc_id"), ("low", F.min, "content"), ("high", F.max, "content")],
    )
    branches = F.col("low") != F.col("high")
    packed = (F.shiftleft(F.col("start").cast("long"), 5) + F.col("count")).alias("span")
    repeated = stored(
        met.where((F.col("first") < F.col("last")) & (branches | (F.col("doc_id") > F.col("first")))).select(
            "doc_id", "copy", packed, branches.alias("branches")
        ),
        "repeated_paths",
    )

    # both joins ask for the same rows, so the texts are dealt out once and the exchange is used again
    rest = f", rest {texts.schema['rest'].dataType.simpleString()}" if carry else ""
    kinds = "doc_id bigint, copy bigint, packed binary" + rest
    wanted = ["doc_id", "packed", "spans"] + ["rest"] * carry
    nameless = texts.where("doc_id IS NULL").withColumns(
        {"packed": F.coalesce("text", F.lit("")).cast("binary"), "spans": F.array().cast("array<bigint>")}
    )
    sources = texts.where("doc_id IS NOT NULL").mapInArrow(_pack, kinds).where("doc_id IS NOT NULL AND copy IS NOT NULL")
    # with a merge join, packing and reading never run in one task, which would then hold two Python workers
    sources = sources.hint("merge")
    apart = _listed(repeated.where("branches"), "paths", shared_ids)
    edges = (
        sources.join(apart, ["doc_id", "copy"])
        .select("doc_id", "copy", "packed", "paths")
        .mapInArrow(_expand, "edge bigint, edge_again bigint, doc_id bigint, copy bigint, start int")
    )
    # one row for each edge that several documents have, joined back: the join splits where an edge is frequent
    shared = reduced(edges, ["edge", "edge_again"], F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = shared.where("first < last").select("edge", "edge_again", "first")
    later = edges.join(shared, ["edge", "edge_again"]).where("doc_id > first")
    single = (F.shiftleft(F.col("start").cast("long"), 5) + 1).alias("span")
    covered = repeated.where("NOT branches").select("doc_id", "copy", "span").unionByName(
        later.select("doc_id", "copy", single)
    )
    spans = _listed(covered, "spans", shared_ids)
    return (
        sources.join(spans, ["doc_id", "copy"], "left")
        .select(*wanted)
        .unionByName(nameless.select(*wanted))
        .mapInArrow(_cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string, text string" + rest)
    )
