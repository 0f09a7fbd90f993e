"""Near duplicates by the Jaccard similarity of word shingles, with Bayesian pruning of candidates.

A text is its set of ``SHINGLE``-word shingles. Texts of equal sets are one class and go on as one node, with one of the texts. Each node has ``HASHES`` MinHash
values; nodes that agree on all ``ROWS`` values of a band are candidates. Their values are compared a chunk at a time, and a
pair is dropped as soon as the posterior probability that its similarity reaches the threshold (uniform prior) falls below
``TOLERANCE``. What is left is connected into clusters, and within each cluster every pair is pruned in the same way and then verified
on the exact sets.

No pair is ever a row: buckets and clusters are compared in cells of two blocks of bounded size, and a cell returns a spanning forest
of its links and each node's number of links. A pair of similarity exactly at the threshold has no common band with probability
``(1 - 0.8**ROWS)**BANDS`` (3e-6) and is pruned with about ``TOLERANCE``; both vanish quickly above it.

Results in special cases: a null or blank text links to nothing and is its own class; a text of fewer words than a shingle is one
shingle; a null id takes no part and has no class; rows that share an id are in one class; repeated rows count as links to each
other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.graphs import connected_components
from pasarlens.llm.scratch import bounded_batches, reduced, stored
from pasarlens.llm.text_arrays import (
    SPACED,
    find_words,
    mix,
    packed_texts,
    pieces,
    range_hashes,
    unpacked_pieces,
    window_hashes,
    window_places,
)

SHINGLE = 5
THRESHOLD = 0.8
ROWS = 4
BANDS = 24
HASHES = ROWS * BANDS
CHUNK = 16
TOLERANCE = 1e-6
#: Nodes and shingles of a block; a cell holds two.
BLOCK_NODES = 256
BLOCK_SHINGLES = 1 << 20
_TILE = 4096
#: Rows that take part in the join.
USABLE = "doc_id IS NOT NULL AND size > 0"

_draw = np.random.default_rng(5)
_TIMES = (_draw.integers(0, 2**31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_PLUS = _draw.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text: text and 64-bit hash, sorted."""
    words = find_words(data, offsets, SPACED)
    count = np.diff(words.offsets)
    ok = window_places(words.offsets, SHINGLE)
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    short = mix(range_hashes(words.hashes, words.offsets[few], words.offsets[few + 1]) + count[few].astype(np.uint64))
    row = np.concatenate([words.row[: len(ok)][ok], few])
    value = np.concatenate([window_hashes(words.hashes, SHINGLE)[ok], short])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def signatures(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """MinHash values of each text (the largest value where a text has no shingles)."""
    out = np.full((n, HASHES), 2**32 - 1, np.uint32)
    low = (value >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(row), _TILE):
        own = row[a : a + _TILE]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        least = np.minimum.reduceat(low[a : a + _TILE, None] * _TIMES + _PLUS, first, axis=0)
        out[own[first]] = np.minimum(out[own[first]], least)
    return out


def _band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(signature), b + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key ^ signature[:, b * ROWS + r])
        keys[:, b] = key
    return keys


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in pieces(batch.column(1)):
            n = b - a
            row, value = shingles(data, offsets)
            signature = signatures(row, value, n)
            set_a, set_b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            np.add.at(set_a, row, mix(value))
            np.add.at(set_b, row, mix(value ^ np.uint64(0x5DEECE66D1234567)))
            keys = _band_keys(signature).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, n),
                    pa.array(set_a.view(np.int64)),
                    pa.array(set_b.view(np.int64)),
                    pa.array(np.bincount(row, minlength=n)),
                    batch.column(2).slice(a, n),
                    pa.array([s.tobytes() for s in signature.astype("<u2")], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys)),
                ],
                ["doc_id", "set_a", "set_b", "size", "text_hash", "signature", "bands"],
            )


def least_matches(threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """After so many values, so many must agree: with fewer, the posterior probability of reaching the threshold, which is that of
    a binomial of one trial more, is below the tolerance."""
    out = []
    for n in range(CHUNK, HASHES + 1, CHUNK):
        total, m = 0.0, -1
        while total < TOLERANCE:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _candidates(left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature matrices that are never dropped; of one matrix each pair once."""
    a, b = np.triu_indices(len(left), 1) if same else np.divmod(np.arange(len(left) * len(right)), max(1, len(right)))
    agree = np.zeros(len(a), np.int16)
    done = 0
    for n, least in needed:
        agree += (left[a, done:n] == right[b, done:n]).sum(1, dtype=np.int16)
        stay = agree >= least
        a, b, agree, done = a[stay], b[stay], agree[stay], n
    return a, b


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges from the smallest node of each component to its others."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(root(x), x) for x in parent if root(x) != x]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), HASHES)


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """The two blocks of a cell, or the one block twice."""
    left = table.filter(pa.array(table.column("block").to_numpy() == table.column("low").to_numpy()))
    if table.column("low")[0] == table.column("high")[0]:
        return left, left, True
    return left, table.filter(pa.array(table.column("block").to_numpy() == table.column("high").to_numpy())), False


def _connect_cell(table: pa.Table) -> pa.Table:
    """A forest of the pairs of a bucket's cell that pruning leaves."""
    left, right, same = _sides(table)
    a, b = _candidates(_matrix(left.column("signature")), _matrix(right.column("signature")), least_matches(), same)
    edges = _forest(left.column("node").to_numpy()[a], right.column("node").to_numpy()[b])
    return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each pair of sets shares: products of indicator matrices, over a tile of shared values at a time."""
    sets = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (left, right)]
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    shared = np.intersect1d(sets[0], sets[1])
    out = np.zeros((len(left), len(right)), np.int64)
    places = [np.searchsorted(shared, s) for s in sets]
    for k in (0, 1):
        held = np.append(shared, 0)[places[k]] == sets[k] if len(shared) else np.zeros(len(sets[k]), bool)
        held &= places[k] < len(shared)
        order = np.argsort(places[k][held], kind="stable")
        places[k], rows[k] = places[k][held][order], rows[k][held][order]
    for start in range(0, len(shared), _TILE):
        tiles = []
        for k, n in enumerate((len(left), len(right))):
            low, high = np.searchsorted(places[k], [start, start + _TILE])
            tile = np.zeros((n, min(_TILE, len(shared) - start)), np.float32)
            tile[rows[k][low:high], places[k][low:high] - start] = 1
            tiles.append(tile)
        out += (tiles[0] @ tiles[1].T).astype(np.int64)
    return out


def _verify_cell(table: pa.Table) -> pa.Table:
    """Of a cluster's cell: each node's links to nodes of the other block (counted in texts), and a forest of them."""
    left, right, same = _sides(table)
    a, b = _candidates(_matrix(left.column("signature")), _matrix(right.column("signature")), least_matches(), same)
    nodes, others = left.column("node").to_numpy(), right.column("node").to_numpy()
    differ = nodes[a] != others[b]
    a, b = a[differ], b[differ]
    if len(a):
        used_a, a = np.unique(a, return_inverse=True)
        used_b, b = np.unique(b, return_inverse=True)
        left, right = left.take(pa.array(used_a)), right.take(pa.array(used_b))
        nodes, others = nodes[used_a], others[used_b]
        sets = [[np.frombuffer(s, "<u8") for s in side.column("shingles").to_pylist()] for side in (left, right)]
        common = _common(*sets)[a, b]
        sizes = [np.array([len(s) for s in side]) for side in sets]
        limit = Fraction(str(THRESHOLD))
        linked = common * limit.denominator >= limit.numerator * (sizes[0][a] + sizes[1][b] - common)
        a, b = a[linked], b[linked]
    n_left = np.bincount(a, right.column("copies").to_numpy()[b], len(nodes)) if len(a) else np.zeros(len(nodes))
    n_right = np.bincount(b, left.column("copies").to_numpy()[a], len(others)) if len(a) else np.zeros(len(others))
    edges = _forest(nodes[a], others[b])
    counted = [(int(x), None, int(n)) for x, n in [*zip(nodes, n_left), *zip(others, n_right)] if n]
    rows = counted + [(x, y, None) for x, y in edges]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.table(dict(zip(("a", "b", "links"), (pa.array(c, pa.int64()) for c in columns), strict=True)))


def _cells(rows: DataFrame, key: str) -> DataFrame:
    """Each row in the cells of its group: its block (by hash) with every block of the group. ``blocks`` is their number."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other")
    return rows.select("*", block).select("*", other).select(
        "*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    ).drop("other", "blocks")


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text to the bytes of its sorted shingles, other columns as they are."""
    for batch in batches:
        place = batch.schema.get_field_index("packed")
        for a, b, data, offsets in unpacked_pieces(batch.column(place)):
            row, value = shingles(data, offsets)
            cuts = np.searchsorted(row, np.arange(b - a + 1)).tolist()
            sets = [value[x:y].astype("<u8").tobytes() for x, y in zip(cuts, cuts[1:], strict=False)]
            yield batch.slice(a, b - a).set_column(place, "shingles", pa.array(sets, pa.binary()))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.set_column(2, "packed", packed_texts(batch.column(2)))


def _same_id(classes: DataFrame, usable: DataFrame) -> DataFrame | None:
    """Edges between the nodes of rows that share an id, if there are any."""
    shared = usable.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if shared.isEmpty():
        return None
    rows = usable.select("doc_id", "set_a", "set_b").distinct().join(shared, "doc_id")
    nodes = rows.join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"]).select("doc_id", "node")
    least = reduced(nodes, "doc_id", F.min("node").alias("b"))
    return nodes.join(least, "doc_id").where("node > b").select(F.col("node").alias("a"), "b")


def _linked(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: one row per text, one per node, and the links of nodes."""
    bounded_batches(df.sparkSession)
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sketches = stored(
        rows.mapInArrow(
            _sketch,
            "doc_id bigint, set_a bigint, set_b bigint, size bigint, text_hash bigint, signature binary, bands array<bigint>",
        ),
        "sketches",
    )
    usable = sketches.where(USABLE)
    # texts of equal sets have equal signatures, so any of them will do; the text is that of the smallest id
    classes = stored(
        usable.groupBy("set_a", "set_b")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("least"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
        .select(F.monotonically_increasing_id().alias("node"), "set_a", "set_b", "least.*", "copies", "size", "signature", "bands"),
        "classes",
    )

    members = classes.select("node", F.explode("bands").alias("band"))
    buckets = reduced(members, "band", F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int").alias("blocks")
    meeting = members.join(buckets, "band").select("node", "band", blocks).join(classes.select("node", "signature"), "node")
    close = _cells(meeting, "band").groupBy("band", "low", "high").applyInArrow(_connect_cell, "a bigint, b bigint")
    clusters = stored(connected_components(close), "clusters")

    nodes = classes.select("node", "doc_id", "text_hash", "copies", "size", "signature").join(clusters, "node")
    per_cluster = reduced(nodes, "component", F.count("*").alias("n"), F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    nodes = nodes.join(per_cluster.select("component", blocks), "component")
    # repeated rows become one before they leave their task, so each node meets one text
    texts = (
        rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
        .select("doc_id", "text_hash", "text")
        .mapInArrow(_pack, "doc_id bigint, text_hash bigint, packed binary")
        .groupBy("doc_id", "text_hash")
        .agg(F.first("packed").alias("packed"))
    )
    with_sets = (
        nodes.join(texts.hint("merge"), ["doc_id", "text_hash"])
        .select("node", "copies", "signature", "component", "blocks", "packed")
        .mapInArrow(
            _shingle_sets,
            "node bigint, copies bigint, signature binary, component bigint, blocks int, shingles binary",
        )
    )
    verified = stored(
        _cells(with_sets, "component")
        .groupBy("component", "low", "high")
        .applyInArrow(_verify_cell, "a bigint, b bigint, links bigint"),
        "links",
    )
    return sketches, classes, verified


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: ``class_id``, the smallest id of its group of linked texts, and ``n_links``, the number of other rows whose
    similarity to it is at least the threshold."""
    sketches, classes, verified = _linked(df, id_col, text_col)
    usable = sketches.where(USABLE)
    edges = verified.where("b IS NOT NULL").select("a", "b")
    by_id = _same_id(classes, usable)
    groups = connected_components(edges if by_id is None else edges.unionByName(by_id))
    in_groups = classes.select("node", "doc_id").join(groups, "node")
    least = reduced(in_groups, "component", F.min("doc_id").alias("class_id"))
    named = in_groups.join(least, "component").select("node", "class_id")
    links = verified.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    by_class = (
        classes.select("set_a", "set_b", "node", "doc_id", "copies")
        .join(named, "node", "left")
        .join(links, "node", "left")
        .select(
            "set_a", "set_b", F.coalesce("class_id", "doc_id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    alone = sketches.where("doc_id IS NULL OR size = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    linked = usable.select("doc_id", "set_a", "set_b").join(by_class, ["set_a", "set_b"])
    return linked.select("doc_id", "class_id", "n_links").unionByName(alone)


def first_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text hash (``xxhash64``) of one text of each group of linked texts, that of the smallest id. Texts under one id are
    only in one group if they are linked; each text without words is a group of its own."""
    sketches, classes, verified = _linked(df, id_col, text_col)
    groups = connected_components(verified.where("b IS NOT NULL").select("a", "b"))
    own = classes.select("node", F.struct("doc_id", "text_hash").alias("least")).join(groups, "node", "left")
    firsts = own.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("least").alias("least"))
    alone = sketches.where("doc_id IS NOT NULL AND size = 0").select("doc_id", "text_hash").distinct()
    return firsts.select("least.*").unionByName(alone)
