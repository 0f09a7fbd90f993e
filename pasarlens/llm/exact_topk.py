"""Exact top-k by inner product with block-at-a-time pruning.

Components become integers, ``floor(scale * x)``. Vectors are ordered by the signs of a few fixed projections, so that alike vectors
are neighbours, and cut into blocks. A block keeps its vectors (the forward index) and each term's largest and smallest value. For a
query the summed term maxima bound every score in a block: blocks are scored in descending order of that bound until it falls
below the k-th best score so far, which begins with the k-th best of the query's own block.

Queries and blocks meet in cells of a group of queries and a shard of blocks; both have a bounded size, so a cell's memory is bounded. A
cell returns at most k rows per query; a window over these gives the result.

Results in special cases: vectors that are null or hold null or non-finite components, and rows with a null id, take no part;
shorter vectors count as filled up with zeros; rows with the query's own id are never its results; other repeated rows count each; a
repeated query row is answered each time; an empty table gives an empty result; other columns are ignored. Scores beyond 64 bits
are cut to the largest or smallest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.scratch import stored

BLOCK_ROWS = 128
SHARD_BLOCKS = 128
QUERY_GROUP = 4096
PROJECTIONS = 16
#: The smallest score there is, so that as a bound it shuts nothing out.
_LOWEST = -(2**63)
_EXACT = 2.0**53

BLOCKS = (
    "kind string, number bigint, id bigint, width int, least bigint, ids binary, vectors binary, highest binary, lowest binary"
)


def _matrix(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Usable rows, and their integer components as floats (0 beyond a shorter vector)."""
    column = column.cast(pa.list_(pa.float64())) if column.type != pa.list_(pa.float64()) else column
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = column.flatten()
    values = np.asarray(flat.fill_null(np.nan).to_numpy(zero_copy_only=False), float)
    row = np.repeat(np.arange(len(lengths)), lengths)
    usable = np.asarray(column.is_valid())
    usable[row[~np.isfinite(values)]] = False
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    with np.errstate(invalid="ignore", over="ignore"):
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.floor(scale * values)
    return np.flatnonzero(usable & np.isfinite(out).all(1)), out


def _codes(x: np.ndarray) -> np.ndarray:
    """The signs of fixed projections as a number."""
    signs = np.random.default_rng(11).choice([-1.0, 1.0], (x.shape[1], PROJECTIONS))
    return ((x @ signs) > 0) @ (1 << np.arange(PROJECTIONS))


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in floating point where every sum is below 2**53, else in whole numbers."""
    width = max(queries.shape[1], vectors.shape[1])
    q, v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, vectors))
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, width) < _EXACT:
        return (q @ v.T).astype(np.int64)
    whole = np.array([[int(a) for a in r] for r in q], object) @ np.array([[int(a) for a in r] for r in v], object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each query, by score and then the smaller id; sorted by query."""
    order = np.lexsort((ids, -score.astype(object) if score.min(initial=0) == -(2**63) else -score, query))
    own = query[order]
    nth = np.arange(len(order)) - np.searchsorted(own, own)
    return order[nth < k]


def build_blocks(df: DataFrame, every: int, k: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Block rows, and query rows with the k-th best score of their own block."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _matrix(batch.column(1), scale)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_codes(x)[rows].astype(np.int32)),
                    batch.column(0).take(pa.array(rows)),
                    pa.array([r.tobytes() for r in x[rows]], pa.binary()),
                ],
                ["code", "id", "vector"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            raw = batch.column(2).to_pylist()
            all_ids = batch.column(1).to_numpy()
            for a in range(0, len(raw), BLOCK_ROWS):
                part, ids = raw[a : a + BLOCK_ROWS], all_ids[a : a + BLOCK_ROWS]
                width = max(len(r) for r in part) // 8
                x = np.frombuffer(b"".join(r.ljust(8 * width, b"\0") for r in part)).reshape(len(part), width)
                rows = [("block", first + n, None, width, 0, ids.tobytes(), x.tobytes(), x.max(0).tobytes(), x.min(0).tobytes())]
                n += 1
                for i in np.flatnonzero(ids % every == 0).tolist():
                    others = np.sort(_products(x[i : i + 1], x[ids != ids[i]])[0])
                    least = int(others[-k]) if len(others) >= k else _LOWEST
                    rows.append(("query", first + n, int(ids[i]), width, least, None, x[i].tobytes(), None, None))
                    n += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES
                )

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL")
    ordered = rows.mapInArrow(coded, "code int, id bigint, vector binary").repartitionByRange("code", "id")
    return ordered.sortWithinPartitions("code", "id").mapInArrow(cut, BLOCKS)


_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
_TYPES = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]
          for c in BLOCKS.split(", ")]


def _stack(table: pa.Table, name: str) -> np.ndarray:
    """A binary column of vectors as a matrix, filled up with zeros."""
    raw = table.column(name).to_pylist()
    width = max((len(r) for r in raw), default=0)
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw)).reshape(len(raw), width // 8)


def _search_cell(cell: pa.Table, k: int) -> pa.Table:
    """The k best rows of the shard's blocks for each query of the group (fewer, if the rest can't be among its best)."""
    kinds = pa.schema([(c, pa.int64()) for c in ("number", "query_id", "vec_id", "score")])
    queries, blocks = (cell.filter(pc.equal(cell.column("kind"), kind)) for kind in ("query", "block"))
    if not queries.num_rows or not blocks.num_rows:
        return kinds.empty_table()
    q = _stack(queries, "vectors")
    own_id, kth = queries.column("id").to_numpy(), queries.column("least").to_numpy().copy()
    m, n = len(q), blocks.num_rows
    out_q, out_s, out_i = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = [np.frombuffer(b, np.int64) for b in blocks.column("ids").to_pylist()]
    vectors = [
        np.frombuffer(b).reshape(len(i), -1) for b, i in zip(blocks.column("vectors").to_pylist(), ids, strict=True)
    ]
    high, low = _stack(blocks, "highest"), _stack(blocks, "lowest")
    width = max(q.shape[1], high.shape[1])
    high, low, wide = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (high, low, q))
    # a block whose vectors are shorter than the query has zeros there, and so have its bounds; shorter vectors in a block
    # were filled up with zeros before the bounds were taken
    with np.errstate(invalid="ignore", over="ignore"):
        bound = np.maximum(wide, 0) @ high.T + np.minimum(wide, 0) @ low.T
        # rounding errors are relative to the terms, which may cancel; a bound that overflows shuts nothing out
        bound += (np.abs(wide) @ np.maximum(np.abs(high), np.abs(low)).T) * (1e-12 + width * 2**-52)
    bound = np.clip(np.nan_to_num(bound, nan=np.inf, posinf=np.inf, neginf=-np.inf), float(_LOWEST), None)
    order = np.argsort(-bound, axis=1, kind="stable")
    going = np.arange(m)
    for step in range(n):
        block = order[going, step]
        going = going[bound[going, block] >= kth[going]]
        if not len(going):
            break
        block = order[going, step]
        by_block = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[by_block], prepend=-1))
        found = [(out_q, out_s, out_i)]
        for a, b in zip(cuts, [*cuts[1:], len(by_block)], strict=True):
            rows, one = going[by_block[a:b]], int(block[by_block[a]])
            score = _products(q[rows], vectors[one])
            keep = (score >= kth[rows, None]) & (ids[one] != own_id[rows, None])
            r, c = np.nonzero(keep)
            found.append((rows[r], score[r, c], ids[one][c]))
        out_q, out_s, out_i = (np.concatenate(x) for x in zip(*found, strict=True))
        best = _best(out_q, out_s, out_i, k)
        out_q, out_s, out_i = out_q[best], out_s[best], out_i[best]
        full = np.flatnonzero(np.bincount(out_q, minlength=m) == k)
        last = np.searchsorted(out_q, full, "right") - 1
        kth[full] = np.maximum(kth[full], out_s[last])
    number = queries.column("number").to_numpy()
    return pa.table(
        {"number": number[out_q], "query_id": own_id[out_q], "vec_id": out_i, "score": out_s},
        schema=kinds,
    )


def exact_topk(
    df: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each row whose id is divisible by ``every``: the k other rows of highest integer inner product."""
    rows = stored(build_blocks(df, every, k, scale, id_col, vector_col), "vector_blocks")
    count = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    shards = -(-count.get("block", 0) // SHARD_BLOCKS) or 1
    groups = -(-count.get("query", 0) // QUERY_GROUP) or 1

    def spread(parts: int, name: str):
        return F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int").alias(name)

    def each(parts: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)

    # the stated queries against all rows, in blocks: a block goes to every group of queries, a query to every shard
    blocks = rows.where("kind = 'block'").select("*", spread(shards, "shard"), each(groups, "grp"))
    queries = rows.where("kind = 'query'").select("*", each(shards, "shard"), spread(groups, "grp"))
    found = (
        queries.unionByName(blocks)
        .groupBy("shard", "grp")
        .applyInArrow(lambda cell: _search_cell(cell, k), "number bigint, query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
