"""Quality rules: a threshold table compiled into one projection, without user functions.

Results in special cases: a null text is the empty text (no words, so it fails the base); a null id is passed on; repeated
rows are judged one by one; an empty table gives an empty result; other columns of the input are ignored. A text of any length is
measured whole; a ratio exactly at its threshold passes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on are as with they be at this have from or by not but what an the "
    "le la les de des du un une et est en que qui dans pour par sur au ne pas il elle plus ce "
    "der die das und ist von zu mit den dem ein eine nicht auf für im sich auch als an es "
    "el los las del y que se con una por para su lo como más o a"
).split()

#: As they stand, capitalised, or in capitals.
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``low <= value <= high`` must hold; ``value`` is an SQL expression over the measures."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.coalesce(F.expr(self.value), F.lit(0.0))
        limits = [value >= self.low] if self.low is not None else []
        limits += [value <= self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, limits, F.lit(True))


#: The threshold table. Ratios are per word or per line; a ratio over nothing counts as 0.
RULES = (
    Rule("mean_word_length", "try_divide(word_chars, n_words)", 2.0, 15.0),
    Rule("symbols_per_word", "try_divide(n_symbols, n_words)", None, 0.1),
    Rule("stop_word_share", "try_divide(n_stop_words, n_words)", 0.02, None),
    Rule("repeated_line_share", "try_divide(n_dup_lines, n_lines)", None, 0.5),
)

#: Fewer words, or a larger share of words in repeated three-word windows, always fail.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _measured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Projections only: each step adds arrays that the next one reads, so nothing is computed twice."""
    text = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    split = text.select(
        "doc_id",
        F.array_remove(F.split("_text", BLANKS), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        (F.size(F.split("_text", SYMBOLS)) - 1).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        "doc_id",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
        F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))).alias("_all"),
    )
    # windows are compared by hash first; only those whose hash occurs twice are compared by their words
    hashed = counted.withColumn(
        "_hashes",
        F.when(F.size("_words") >= 3, F.slice("_all", 1, F.greatest(F.size("_words") - 2, F.lit(1))))
        .otherwise(F.array().cast("array<bigint>")),
    ).drop("_all")
    sorted_ = hashed.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
            F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("w"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<w:bigint,i:int>>")),
    ).drop("_hashes")
    suspects = sorted_.withColumn(
        "_exact",
        F.array_sort(
            F.transform(
                _met_twice("_sorted"),
                lambda x: F.struct(
                    F.concat_ws(
                        " ", F.get("_words", x["i"]), F.get("_words", x["i"] + 1), F.get("_words", x["i"] + 2)
                    ).alias("w"),
                    x["i"].alias("i"),
                ),
            )
        ),
    ).drop("_sorted", "_words")
    covered = F.flatten(F.transform(_met_twice("_exact"), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return suspects.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long")).drop("_exact")


def _met_twice(ordered: str) -> Column:
    """Of a sorted array of windows with their places, those equal to a neighbour."""
    return F.filter(
        ordered, lambda x, i: (F.get(ordered, i - 1)["w"] == x["w"]) | (F.get(ordered, i + 1)["w"] == x["w"])
    )


def quality_rules(
    df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per text: the measures, whether the base rules fail, and whether the text is kept."""
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    verdict = reduce(lambda a, b: a & b, [rule.holds() for rule in rules], F.lit(True))
    return _measured(df, id_col, text_col).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict).alias("kept"), "n_lines", "n_stop_words",
    )
