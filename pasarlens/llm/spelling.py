"""Words grouped with their spelling variants by a bit-sliced position index.

Words are counted over the whole corpus by Spark. Two words that differ by one letter agree in the letters before a cut or in
those after it, so each word is dealt to the cells of its halves (for its own length and the next one). In a cell the vocabulary
is a set of bit rows, one for each (position, letter): a word's letters are followed through these rows for all words of the
cell at once, with one set of the words met without an error and one set for each kind of single error, whose rows are
read at the same position (replaced), at the next one (inserted) or at the one before (deleted). Only counts and the best
word of each cell leave it. A pair counts in the one cell that its first half names, or else its second half.

Results in special cases: a null text has no words, a null id makes the text before the colon empty; equal rows count as often as
they stand there; of near words with equal counts the smallest in code-point order is the form; an empty table, or one
without words that are frequent enough, gives no rows. Texts and words of any length are handled whole (a cell is bounded by
letters as well as by words); other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.scratch import stored

#: What is a word's letter, and which of them are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One of so many (by hash) loses a letter.
DAMAGED = 97
LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
#: Bounds of a cell.
CELL_WORDS, CELL_LETTERS = 1024, 1 << 20

_FULL = np.uint64(2**64 - 1)


def corpus_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``: all words of the texts, some of them damaged by one letter, with their number."""
    runs = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(LETTERS), F.lit(0))
    run = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = run.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    without = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(h % DAMAGED == 0, without).otherwise(F.col("run"))
    return run.groupBy(word.alias("word")).agg(F.count("*").alias("n"))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    words = corpus_words(docs, doc_id, text)
    return words.where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LETTERS))


def _halves(words: DataFrame) -> DataFrame:
    """Each word once for every half it may share: ``size`` is the longer length of a pair, ``cut`` the letters before the cut."""
    size = F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("size")
    rows = words.select("word", "n", size).withColumn("cut", F.expr("size div 2"))
    rows = rows.withColumn("tail", F.explode(F.array(F.lit(False), F.lit(True))))
    behind = F.expr("right(word, size - cut)")
    return rows.withColumn("half", F.when(F.col("tail"), behind).otherwise(F.substring(F.col("word"), F.lit(1), F.col("cut"))))


def _cells(words: DataFrame) -> DataFrame:
    """Rows dealt to cells of bounded size. A bucket that is too large, because many words share a half, becomes several blocks, and
    each pair of blocks a cell, so that nothing is left out."""
    halves = stored(_halves(words), "halves")
    most = F.greatest(F.lit(1), F.least(F.lit(CELL_WORDS), F.lit(CELL_LETTERS) / F.col("size"))).cast("long")
    sizes = halves.groupBy("size", "tail").agg(F.count("*").alias("rows"))
    # one short row per length, stored so that Spark knows its size and the halves need not be dealt out by length
    sizes = stored(sizes.select("size", "tail", most.alias("most"), F.ceil(2 * F.col("rows") / most).alias("buckets")), "sizes")
    dealt = halves.join(sizes, ["size", "tail"]).withColumn("bucket", F.pmod(F.xxhash64("half"), F.col("buckets")))
    held = dealt.groupBy("size", "tail", "bucket", F.col("most")).agg(F.count("*").alias("rows"))
    blocks = held.select("size", "tail", "bucket", F.ceil(F.col("rows") / F.col("most")).alias("blocks"))
    dealt = dealt.join(blocks, ["size", "tail", "bucket"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    each = dealt.select("word", "n", "size", "cut", "tail", "half", "bucket", "own", other)
    asked, held = (each.select(
        "word", "n", "size", "cut", "tail", "half", "bucket", F.lit(role).alias("asks"),
        F.col(a).alias("i"), F.col(b).alias("j"),
    ) for role, a, b in ((True, "own", "other"), (False, "other", "own")))
    return asked.unionByName(held)


class PositionIndex:
    """Bit rows of (position, letter) over a list of words; the first bit is the first word."""

    def __init__(self, words: list[str]):
        self.count = len(words)
        self.slots = -(-max(1, len(words)) // 64)
        self.lengths = np.array([len(w) for w in words], np.int64)
        letters = _letters(words)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        self.keys, row = np.unique(place << 21 | letters, return_inverse=True)
        # one row more, of zeros, for what stands in no word
        self.rows = np.zeros((len(self.keys) + 1, self.slots), np.uint64)
        np.bitwise_or.at(self.rows, (row, owner >> 6), np.uint64(1) << (owner & 63).astype(np.uint64))

    def at(self, place: int, letters: np.ndarray) -> np.ndarray:
        """Bit row of each letter at a position."""
        keys = place << 21 | letters
        found = np.searchsorted(self.keys, keys)
        known = found < len(self.keys)
        known[known] = self.keys[found[known]] == keys[known]
        return self.rows[np.where(known & (place >= 0), found, len(self.keys))]

    def where(self, chosen: np.ndarray) -> np.ndarray:
        """Bits of the chosen words."""
        bits = np.zeros(self.slots * 64, np.uint8)
        bits[: self.count] = chosen
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def near(self, words: list[str], cut: int) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length: the bits of the words one replaced, inserted or deleted letter away, and of those that begin
        with the same ``cut`` letters."""
        size = len(words[0])
        letters = _letters(words).reshape(len(words), size)
        none = np.zeros((len(words), self.slots), np.uint64)
        exact, same, longer, shorter, begins = none + self.where(np.ones(self.count, bool)), none, none, none, none
        for place in range(size):
            if place == cut:
                begins = exact
            here, after, before = (self.at(place + shift, letters[:, place]) for shift in (0, 1, -1))
            same = (same & here) | (exact & ~here)
            longer = (longer | exact) & after
            shorter = (shorter & before) | exact
            exact = exact & here
        begins = exact if cut >= size else begins
        found = same & self.where(self.lengths == size)
        found |= (longer | exact) & self.where(self.lengths == size + 1)
        found |= shorter & self.where(self.lengths == size - 1)
        return found, begins


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)


def _first_bit(found: np.ndarray) -> np.ndarray:
    """Number of the first set bit of each row (rows must have one)."""
    slot = (found != 0).argmax(axis=1)
    value = found[np.arange(len(found)), slot]
    return slot * 64 + np.bitwise_count((value & (~value + np.uint64(1))) - np.uint64(1)).astype(np.int64)


def search_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """Of each asking word: near words that share its half, their number and the best one (largest count, then smallest)."""
    size, cut, tail = int(cell["size"].iloc[0]), int(cell["cut"].iloc[0]), bool(cell["tail"].iloc[0])
    held = cell[~cell["asks"]].sort_values(["n", "word"], ascending=[False, True])
    asks = cell[cell["asks"]]
    out = []
    if len(held) and len(asks):
        index = PositionIndex(held["word"].tolist())
        halves, member = np.unique(held["half"].to_numpy(str), return_inverse=True)
        shared = np.zeros((len(halves) + 1, index.slots), np.uint64)
        np.bitwise_or.at(
            shared, (member, np.arange(len(held)) >> 6), np.uint64(1) << (np.arange(len(held)) & 63).astype(np.uint64)
        )
        longest = index.where(index.lengths == size)
        for length, group in asks.groupby(asks["word"].str.len()):
            words, half = group["word"].tolist(), group["half"].to_numpy(str)
            found, begins = index.near(words, cut)
            place = np.minimum(np.searchsorted(halves, half), len(halves) - 1)
            found &= shared[np.where(halves[place] == half, place, len(halves))]
            if length < size:
                found &= longest
            if tail:
                found &= ~begins
            number = np.bitwise_count(found).sum(axis=1).astype(np.int64)
            some = np.flatnonzero(number)
            best = _first_bit(found[some])
            out.append(pd.DataFrame({
                "word": np.array(words, object)[some], "n_near": number[some],
                "form_n": held["n"].to_numpy()[best], "form": held["word"].to_numpy()[best],
            }))
    return pd.concat(out) if out else pd.DataFrame({"word": [], "n_near": [], "form_n": [], "form": []})


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``form`` and ``form_n`` of the words that have a near word."""
    keys = ["size", "tail", "bucket", "i", "j"]
    found = _cells(words).groupBy(*keys).applyInPandas(search_cell, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a form. Each round doubles the steps taken; counts at least double with each
    step, so that few rounds lead to the end."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(ahead, "root", "left"), "roots")
        if now.where("next IS NOT NULL").isEmpty():
            return now.select("word", "root")
        now = now.select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of the vocabulary."""
    words = stored(vocabulary(docs, doc_id, text), "words")
    found = words.join(near_words(words), "word", "left")
    formed = F.col("form_n") >= RATIO * F.col("n")
    found = stored(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"),
    ), "forms")
    return found.join(roots(found.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
