"""Best-fit packing of documents into sequences of bounded length.

Only the histogram of lengths (at most ``capacity`` counts) reaches the driver. There a configuration linear program is solved: a
configuration is a multiset of lengths that fits into one sequence, and each length must be covered as often as it occurs.
Multiplicative weights price the lengths; a knapsack dynamic program finds, for every length, the best-paying configuration that
holds it. Rounding down gives whole sequences; what is left is solved again, and the last of it is put, longest first, where it
fits best. No more sequences are used than plain best fit needs. Pieces then get their places
by their rank among pieces of equal length, which Spark counts in two levels, so that no length's pieces meet in one task.

Results in special cases: a null text is the empty text, which is the end mark alone; a null id is passed on; repeated rows are packed
each; an empty table gives an empty result; other columns are ignored. A text longer than the capacity is cut, the
remainder first.
"""

from __future__ import annotations

import logging
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.byte_bpe import binaries, encoder
from pasarlens.llm.scratch import bounded_batches, stored
from pasarlens.llm.text_arrays import pieces

#: Rounds of pricing; how much less than the best configuration one may pay; the share of a length's pieces it takes at once.
ROUNDS, SLACK, SHARE = 60, 0.005, 0.5
#: How often the program is solved for what rounding leaves.
TURNS = 4

_log = logging.getLogger(__name__)

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def _cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number, start and length of each piece; a remainder comes first."""
    count = -(-sizes // capacity)
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = (sizes - (count - 1) * capacity)[text]
    start = np.where(number == 0, 0, first + (number - 1) * capacity)
    return text, number, start, np.where(number == 0, first, capacity)


def tokenized_pieces(
    df: DataFrame,
    vocabulary: str = "byte_bpe_50k.json",
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of each text's ids and end mark, with its task and its rank there among pieces of its length."""

    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                ids, places = own.encode(data, offsets)
                marked = np.insert(ids, places[1:], end_id).astype("<u4")
                begins = places[:-1] + np.arange(b - a)
                text, number, start, length = _cut(np.diff(places) + 1, capacity)
                low = begins[text] + start
                raw = memoryview(marked.tobytes())
                checks = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(low.tolist(), (low + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                grouped = length[order]
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(order)) - np.searchsorted(grouped, grouped)
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    batch.column(0).slice(a, b - a).take(pa.array(text)),
                    pa.array(number.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(checks, pa.int64()),
                    pa.array(np.full(len(text), task, np.int32)),
                    pa.array(nth),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if with_ids:
                    columns.append(binaries(marked, np.append(low, len(marked))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def _knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each room, and the length last taken there (negative: none); any number of each length may be taken."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fits[room]:
            value = best[room - lengths[:n]] + price[:n]
            # among equally good, the longest
            i = n - 1 - int(value[::-1].argmax())
            if value[i] > best[room]:
                best[room], taken[room] = value[i], lengths[i]
    return best, taken


def _configuration(length: int, taken: np.ndarray, capacity: int) -> tuple[int, ...]:
    """``length`` and the best filling of the room beside it."""
    out, room = [length], capacity - length
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            out.append(int(taken[room]))
            room -= out[-1]
    return tuple(sorted(out, reverse=True))


def solve_configurations(counts: dict[int, int], capacity: int) -> tuple[dict[tuple[int, ...], float], float]:
    """A fractional solution of the configuration program (how often each configuration is used), and a lower bound of its value.

    A length's price is its weight over its count; a weight falls as its length is covered. Each round prices all configurations by the
    knapsack program and uses those that pay nearly most, each as far as it takes a share of a length's pieces and no more pieces
    than are left, so that nothing is covered twice. What no configuration has covered after the last round is left to the
    rounding. By duality the sum of the weights over the best price is a lower bound in every round.
    """
    lengths = np.array(sorted(n for n in counts if n < capacity))
    use: Counter = Counter()
    if not len(lengths):
        return {}, 0.0
    need = np.array([counts[n] for n in lengths], float)
    place = {int(n): i for i, n in enumerate(lengths)}
    weight, covered, bound, slack = need * lengths / capacity, np.zeros(len(lengths)), 0.0, SLACK
    for _ in range(ROUNDS):
        price = weight / need
        best, taken = _knapsack(price, lengths, capacity)
        bound = max(bound, weight.sum() / best[capacity])
        pays = (price + best[capacity - lengths]) / best[capacity]
        good = np.flatnonzero((pays >= 1 - slack) & (covered < 1))
        for i in good[np.argsort(-pays[good], kind="stable")].tolist():
            chosen = _configuration(int(lengths[i]), taken, capacity)
            times = Counter(chosen)
            at = np.array([place[n] for n in times])
            each = np.array(list(times.values())) / need[at]
            amount = float(min((SHARE / each).min(), ((1 - covered[at]) / each).min()))
            if amount > 0:
                use[chosen] += amount
                covered[at] += each * amount
                weight[at] *= np.exp(-each * amount)
        if covered.min() >= 1:
            break
        slack *= 1.05
    return dict(use), bound


def _whole_part(use: dict[tuple[int, ...], float], left: Counter) -> Counter:
    """Configurations rounded down, taken from what is ``left``; those with room to spare are not used."""
    whole: Counter = Counter()
    for chosen, amount in sorted(use.items(), key=lambda x: (-sum(x[0]), x[0])):
        times = Counter(chosen)
        n = min(int(amount + 1e-9), *(left[s] // k for s, k in times.items()))
        if n > 0:
            whole[chosen] += n
            for s, k in times.items():
                left[s] -= n * k
    return whole


def pack_counts(counts: dict[int, int], capacity: int) -> tuple[dict[tuple[int, ...], int], int]:
    """How often each configuration is used so that every piece is held once, and the fewest sequences that any packing needs.

    The program is solved and rounded down, again for what that leaves, and the last of it is put where it fits best. Plain best
    fit of all pieces is used instead where it needs fewer sequences.
    """
    left: Counter = Counter({n: k for n, k in counts.items() if n < capacity})
    full = counts.get(capacity, 0)
    whole, bound = Counter({(capacity,): full} if full else {}), 0.0
    for turn in range(TURNS):
        use, own = solve_configurations(left, capacity)
        bound = own if turn == 0 else bound
        tight = {c: n for c, n in use.items() if sum(c) >= capacity - capacity // 50}
        found = _whole_part(tight, left)
        whole.update(found)
        left = Counter({n: k for n, k in left.items() if k > 0})
        if not found or not left:
            break
    whole.update(_best_fit(left, capacity))
    plain = round_configurations({}, counts, capacity)
    best = min((dict(whole), plain), key=lambda x: sum(x.values()))
    # the program has no value below its bound
    least = full + ceil(bound * (1 - 1e-9))
    _log.info("packing: %d sequences, at least %d needed, plain best fit %d", sum(best.values()), least, sum(plain.values()))
    return best, least


def round_configurations(
    use: dict[tuple[int, ...], float], counts: dict[int, int], capacity: int
) -> dict[tuple[int, ...], int]:
    """Whole numbers of configurations that hold every piece exactly once."""
    left = Counter({n: k for n, k in counts.items() if n < capacity})
    whole = Counter({(capacity,): counts[capacity]} if counts.get(capacity) else {})
    whole.update(_whole_part({c: n for c, n in use.items() if sum(c) == capacity}, left))
    whole.update(_best_fit(left, capacity))
    return dict(whole)


def _best_fit(left: Counter, capacity: int) -> Counter:
    """Best fit, longest first, on groups of equal sequences."""
    # room -> {contents: how many}
    rooms: dict[int, Counter] = {}
    whole: Counter = Counter()
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo > 0:
            room = min((r for r in rooms if r >= length), default=0)
            if not room:
                each = capacity // length
                full, rest = divmod(todo, each)
                for k, n in ((each, full), (rest, 1)):
                    if k and n:
                        rooms.setdefault(capacity - k * length, Counter())[(length,) * k] += n
                break
            contents, n = next(iter(sorted(rooms[room].items())))
            moved = min(n, todo)
            rooms[room][contents] -= moved
            if not rooms[room][contents]:
                del rooms[room][contents]
            if not rooms[room]:
                del rooms[room]
            rooms.setdefault(room - length, Counter())[tuple(sorted((*contents, length), reverse=True))] += moved
            todo -= moved
    for group in rooms.values():
        whole.update(group)
    return whole


def _slots(whole: dict[tuple[int, ...], int], capacity: int) -> tuple[np.ndarray, ...]:
    """Sorted keys (length and first rank) of runs of places, with each run's first sequence and its offset there."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for contents, n in sorted(whole.items(), reverse=True):
        offset = 0
        for length in contents:
            rows.append((length, used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack_pieces(pieces_table: DataFrame, capacity: int = 1024) -> DataFrame:
    """Each row of a stored table of pieces with ``sequence_id`` and ``offset``.

    The driver gets one count per length. The table of places that goes to the tasks has a row per configuration and
    slot: fewer than ``TURNS * ROUNDS * capacity`` configurations from the program and about two per length from the best fit.
    """
    by_task = pieces_table.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    whole, _ = pack_counts(counts, capacity)
    length, first, sequence, offset = _slots(whole, capacity)
    starts = np.searchsorted(length, np.arange(capacity + 2))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces_table.join(offsets, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    kept = [c for c in pieces_table.columns if c not in ("part", "nth")]
    ranked = ranked.select(*kept, "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            at = np.empty(len(n), np.int64)
            for one in np.unique(n).tolist():
                own = n == one
                low, high = starts[one], starts[one + 1]
                at[own] = low + np.searchsorted(first[low:high], rank[own], "right") - 1
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    kinds = {f.name: f.dataType.simpleString() for f in pieces_table.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)


def pack_documents(df: DataFrame, capacity: int = 1024, with_ids: bool = False, **names: str) -> DataFrame:
    """Texts to packed pieces. The pieces are stored once, so that ranks and places are those of one run."""
    return pack_pieces(stored(tokenized_pieces(df, capacity=capacity, with_ids=with_ids, **names), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence (at most ``capacity``), from packed pieces with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["length"]).alias("n_tokens"),
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
