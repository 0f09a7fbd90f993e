"""A dataset manifest: a 16-ary Merkle tree over each source and one over the sources.

Ranks come from a bitmap index, not from sorting leaves. The ids of a source are kept as a compressed bitmap: 64-bit words, of
which only those with a bit are stored, merged by ``or`` from all tasks. A directory of popcounts over words, over blocks of
words and so on gives the number of ids before a word; the popcount of the lower bits in the word does the rest. Windows of the
directory see at most ``2 ** FAN`` rows each, however many ids a source has. A leaf's rank is its coordinate: runs of 16 meet in
an array of keyed slots, whose digest is the slot of the next level.

Leaves of one source that share an id follow each other by their digest; equal rows are as many leaves. Rows without an id come
first in their source, those without a source form a source of their own, which comes first. An empty table gives no rows. Texts
of any length are hashed whole; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.scratch import stored
from pasarlens.operators.ranks import numbered

#: Children of a node, and its logarithm.
RUN, RUN_BITS = 16, 4
#: Ids in a word of the bitmap, and words (or blocks) below an entry of the directory, as logarithms.
WORD, FAN = 6, 16
#: Columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tampering touches rows whose id has a hash divisible by this.
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Word of the rows without an id: below those of all 64-bit ids.
_NO_ID = -(2**57) - 1


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in FIELDS]), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _node(slots: Column) -> Column:
    """Digest of a run's slots in their order."""
    return F.unhex(F.sha2(F.array_join(F.transform(slots, _hex), ""), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """``source``, ``doc_id``, ``leaf`` and ``tampered`` (the leaf of the tampered text), and how many rows are equal in them."""
    text = F.col("text").cast("string")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    tampered = F.when(touched, F.translate(text, _UPPER, _LOWER)).otherwise(text)
    rows = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _leaf(text).alias("leaf"),
        F.when(touched, _leaf(tampered)).alias("tampered"),
    )
    return rows.groupBy("source", "doc_id", "leaf", "tampered").agg(F.count("*").alias("n"))


def _word() -> Column:
    return F.coalesce(F.shiftright("doc_id", WORD), F.lit(_NO_ID))


def _bit() -> Column:
    """Place in the word; that of an absent id is 0."""
    return F.coalesce(F.col("doc_id").bitwiseAND(F.lit(2**WORD - 1)), F.lit(0)).cast("int")


def _power(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bitmap(rows: DataFrame) -> DataFrame:
    """Words of each source's bitmap and the number of leaves in each (more than its bits, if ids repeat)."""
    return rows.groupBy("source", _word().alias("word")).agg(F.bit_or(_power(_bit())).alias("bits"), F.sum("n").alias("n"))


def _levels(words: DataFrame) -> int:
    """Levels of the directory below its top, so that the top has at most ``2 ** FAN`` entries a source."""
    low, high = words.agg(F.min("word"), F.max("word")).first()
    levels = 0
    while low is not None and (high >> FAN * levels) - (low >> FAN * levels) >= 1 << FAN:
        levels += 1
    return levels


def directory(words: DataFrame) -> DataFrame:
    """``before`` (leaves of the source in smaller words) and ``total`` (all its leaves) of each word."""
    levels = _levels(words)

    def block(word: Column, level: int) -> Column:
        return F.shiftright(word, FAN * level)

    def prefix(rows: DataFrame, entry: Column, *within: Column) -> DataFrame:
        group = Window.partitionBy("source", *within)
        sums = F.sum("n").over(group.orderBy(entry).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
        return rows.withColumn("before", sums) if within else rows.withColumns({"before": sums, "total": F.sum("n").over(group)})

    counts = [words.select("source", "word", "bits", "n")]
    for level in range(1, levels + 1):
        counts.append(
            counts[-1].groupBy("source", block(F.col("word"), 1).alias("word")).agg(F.sum("n").alias("n"))
        )
    above = prefix(counts[-1], F.col("word"))
    for below in reversed(counts[:-1]):
        part = prefix(below, F.col("word"), block(F.col("word"), 1)).alias("b")
        same = F.col("b.source").eqNullSafe(F.col("a.source")) & (block(F.col("b.word"), 1) == F.col("a.word"))
        above = part.join(above.alias("a"), same).select(
            *[F.col(f"b.{c}") for c in below.columns],
            (F.col("b.before") + F.col("a.before")).alias("before"),
            F.col("a.total").alias("total"),
        )
    return above


def _single(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Place of the leaves in words that hold each id once."""
    lower = F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), _bit())))
    same = F.col("r.source").eqNullSafe(F.col("i.source")) & (F.col("r.word") == F.col("i.word"))
    return rows.withColumn("word", _word()).alias("r").join(index.where("n = bit_count(bits)").alias("i"), same).select(
        F.col("r.source").alias("source"), "doc_id", "leaf", "tampered", "total",
        (F.col("before") + F.bit_count(lower)).alias("place"),
    )


def _repeated(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Place of the leaves in words where an id has several. Those of an id are ordered by digest: by popcounts over its
    leading bits first, so that no task sorts all leaves of an id; of equal leaves each gets a place of its own."""
    same = F.col("r.source").eqNullSafe(F.col("i.source")) & (F.col("r.word") == F.col("i.word"))
    held = rows.withColumn("word", _word()).alias("r").join(index.where("n <> bit_count(bits)").alias("i"), same)
    head = F.conv(F.substring(F.hex("leaf"), 1, 4), 16, 10).cast("int")
    # an absent id has a word of its own
    held = held.select(
        F.col("r.source").alias("source"), F.col("r.word").alias("word"), _bit().alias("bit"), head.alias("head"),
        "doc_id", "leaf", "tampered", "r.n", "before", "total",
    )
    held = stored(held, "repeated")
    word, running = Window.partitionBy("source", "word").orderBy("bit", "head"), F.sum("n")
    before = Window.unboundedPreceding, Window.currentRow
    heads = held.groupBy("source", "word", "bit", "head").agg(F.sum("n").alias("n"))
    heads = heads.withColumn("start", running.over(word.rowsBetween(*before)) - F.col("n"))
    within = Window.partitionBy("source", "word", "bit", "head").orderBy("leaf", "tampered").rowsBetween(*before)
    placed = held.withColumn("after", running.over(within)).alias("h")
    same = F.col("h.source").eqNullSafe(F.col("k.source")) & (F.col("h.word") == F.col("k.word"))
    same &= (F.col("h.bit") == F.col("k.bit")) & (F.col("h.head") == F.col("k.head"))
    first = F.col("h.before") + F.col("k.start") + F.col("h.after") - F.col("h.n")
    runs = placed.join(heads.alias("k"), same).select(
        F.col("h.source").alias("source"), "doc_id", "leaf", "tampered", "total", first.alias("first"), F.col("h.n").alias("n")
    )
    # equal rows are dealt out in parts, so that one task does not make them all
    parts = runs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div 4096"))))
    parts = parts.repartition("source", "first", "part")
    until = F.least(F.col("n"), (F.col("part") + 1) * 4096) - 1
    return parts.select(
        "source", "doc_id", "leaf", "tampered", "total",
        F.explode(F.sequence(F.col("first") + F.col("part") * 4096, F.col("first") + until)).alias("place"),
    )


def coordinates(rows: DataFrame) -> DataFrame:
    """``place`` of each leaf in its source, from 0, and the number of the source's leaves (``total``)."""
    index = stored(directory(stored(bitmap(rows), "bitmap")), "directory")
    placed = _single(rows, index)
    if index.where("n <> bit_count(bits)").isEmpty():
        return placed
    return placed.unionByName(_repeated(rows, index))


def _runs(nodes: DataFrame, keys: list[str], *values: Column) -> DataFrame:
    """One row per run of nodes, with an array of its slots; ``place`` becomes the run's."""
    slot = F.col("place").bitwiseAND(F.lit(RUN - 1)).cast("int")
    packed = F.map_from_entries(F.collect_list(F.struct(slot, F.struct(*values))))
    return nodes.groupBy(*keys, "total", F.shiftright("place", RUN_BITS).alias("place")).agg(packed.alias("by_slot")).select(
        *keys, "total", "place", F.transform(F.sequence(F.lit(0), F.size("by_slot") - 1), lambda i: F.col("by_slot")[i]).alias("slots")
    )


def _digest(runs: DataFrame, keys: list[str], of: str = "node") -> DataFrame:
    """Nodes of the next level: the digest of each run; the only node of a tree stays as it is."""
    slots = F.transform("slots", lambda s: s[of])
    node = F.when(F.col("total") > 1, _node(slots)).otherwise(slots[0])
    after = F.expr(f"(total + {RUN - 1}) div {RUN}")
    return runs.select(*keys, after.alias("total"), "place", node.alias("node"))


def _tree(first: DataFrame, keys: list[str], of: str, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored runs of all levels, from the leaves on, and the root of each tree."""
    levels = [first]
    while True:
        nodes = _digest(levels[-1], keys, of)
        if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
            return levels, nodes
        of = "node"
        levels.append(stored(_runs(nodes, keys, F.col("node").alias("node")), label))


def _step(slots: Column, at: Column, of: str) -> Column:
    """What stands left and right of a slot, as digests one after another."""
    digests = F.transform(slots, lambda s: s[of])
    return F.struct(
        F.array_join(F.transform(F.slice(digests, F.lit(1), at), _hex), "").alias("left"),
        F.array_join(F.transform(F.slice(digests, at + 2, F.lit(RUN)), _hex), "").alias("right"),
    )


def _path(total: Column, slots: Column, at: Column, above: Column, of: str) -> Column:
    """Steps from a node to the root; a tree of one node has none."""
    here = F.when(total > 1, F.array(_step(slots, at, of))).otherwise(F.array().cast(_STEPS))
    return F.concat(here, above)


_STEPS = "array<struct<left: string, right: string>>"


def _down(levels: list[DataFrame], keys: list[str], top: DataFrame) -> DataFrame:
    """The leaf runs with ``above``, the steps from each run's node to the root. ``top`` has the steps above each tree."""
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    carried = [c for c in top.columns if c not in (*keys, "above")]
    now = levels[-1].alias("b").join(top.alias("a"), same or F.lit(True))
    now = now.select(*[F.col(f"b.{c}") for c in levels[-1].columns], "above", *carried)
    for below in reversed(levels[:-1]):
        at = F.col("b.place").bitwiseAND(F.lit(RUN - 1)).cast("int")
        joined = below.alias("b").join(now.alias("a"), [*same, F.shiftright("b.place", RUN_BITS) == F.col("a.place")])
        now = joined.select(
            *[F.col(f"b.{c}") for c in below.columns],
            _path(F.col("a.total"), F.col("a.slots"), at, F.col("a.above"), "node").alias("above"),
            *[F.col(f"a.{c}") for c in carried],
        )
    return now


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the steps of its path give, as hexadecimal text."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` of every row."""
    rows = stored(leaves(docs), "leaves")
    leaf = [F.col("leaf").alias("node"), F.col("doc_id").alias("doc_id"), F.col("tampered").alias("tampered")]
    first = stored(_runs(coordinates(rows), ["source"], *leaf), "runs")
    levels, subroots = _tree(first, ["source"], "node", "levels")
    # the tree over the sources
    subroots = stored(subroots.select("source", F.col("node").alias("subroot")), "subroots")
    ranked = numbered(subroots, [F.col("source").asc_nulls_first()], "place")
    total = subroots.count()
    tops = ranked.select("place", F.lit(total).cast("long").alias("total"), "source", "subroot")
    named = [F.col("subroot").alias("node"), F.col("source").alias("source")]
    top_levels, roots = _tree(stored(_runs(tops, [], *named), "top_runs"), [], "node", "top_levels")
    root = roots.select(F.col("node").alias("root"), F.array().cast(_STEPS).alias("above"))
    top = _down(top_levels, [], root).select("total", "slots", "above", "root", F.posexplode("slots").alias("at", "slot"))
    top = stored(
        top.select(
            F.col("slot.source").alias("source"), F.col("slot.node").alias("subroot"), "root",
            _path(F.col("total"), F.col("slots"), F.col("at"), F.col("above"), "node").alias("above"),
        ),
        "top_paths",
    )
    runs = _down(levels, ["source"], top)
    each = runs.select("total", "slots", "above", "subroot", "root", F.posexplode("slots").alias("at", "slot")).select(
        F.col("slot.doc_id").alias("doc_id"), F.col("slot.node").alias("leaf"), F.col("slot.tampered").alias("tampered"),
        "subroot", "root", _path(F.col("total"), F.col("slots"), F.col("at"), F.col("above"), "node").alias("path"),
    )
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    found = each.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"),
        folded(_hex(F.coalesce("tampered", "leaf")), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
