"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is reduced to a few measures. Each measure is cut into bins; cyclic boosting visits the measures in turn and adds a
shallow tree on one of them (then on pairs of them) to that measure's lookup table. A score is the sum of the looked-up values.

The model is fitted on the driver from at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id, so that the bound
does not depend on the input; only their measures are sent there. Scoring covers every text.

Results in special cases: a null text is the empty text and is scored as such; a null id is passed on and not held out; rows without a
label, or with another label than 0 and 1, are not learned from; with labels of one kind or none the score is the share of
label 1 (0.5 without any); repeated rows are scored each; an empty table gives an empty result; other columns are ignored. A text
of any length is measured whole; a score of exactly 0.5 predicts label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.quality_rules import STOP_WORDS
from pasarlens.llm.scratch import bounded_batches
from pasarlens.llm.text_arrays import SPACED, find_words, pieces, window_hashes, window_places

#: Labelled rows learned from, about (the hash keeps a share of all labelled rows).
TRAIN_ROWS = 20_000
BINS = 24
ROUNDS = 120
RATE = 0.15
PAIRS = 4
PAIR_BINS = 8
PAIR_ROUNDS = 20
#: Weight added to each leaf, against leaves of few rows.
SHRINK = 4.0

FEATURES = (
    "log_words", "mean_word", "longest_word", "symbols", "marks", "capitals", "digits", "non_ascii", "distinct_words",
    "repeated_windows", "repeated_lines", "words_per_line", "stop_words",
)


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


_CLASSES = {
    "symbols": _class(b"#$%&*+<=>@\\^_`{|}~"),
    "marks": _class(b"!?"),
    "capitals": _class(bytes(range(65, 91))),
    "digits": _class(bytes(range(48, 58))),
    "non_ascii": _class(bytes(range(128, 256))),
}
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LINE_ENDS = np.ones(256, bool)
_LINE_ENDS[0x0A] = False


def _stop_hashes() -> np.ndarray:
    words = sorted({w.encode() for w in STOP_WORDS})
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    return np.sort(find_words(np.frombuffer(b"".join(words), np.uint8), offsets, SPACED, _LOWER).hashes)


_STOP = _stop_hashes()


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many distinct values each row has."""
    order = np.lexsort((values, row))
    r, v = row[order], values[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=n)


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text, one column per feature."""
    n = len(offsets) - 1
    words = find_words(data, offsets, SPACED, _LOWER)
    count = np.diff(words.offsets)
    some = np.maximum(count, 1)
    size = np.maximum(np.diff(offsets), 1)
    lengths = words.ends - words.starts
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, words.row, lengths)
    windows = window_hashes(words.hashes, 3)
    whole = window_places(words.offsets, 3)
    row = words.row[: len(windows)][whole]
    n_windows = np.bincount(row, minlength=n)
    lines = find_words(data, offsets, _LINE_ENDS)
    n_lines = np.maximum(np.diff(lines.offsets), 1)
    at = np.minimum(np.searchsorted(_STOP, words.hashes), len(_STOP) - 1)
    columns = {
        "log_words": np.log1p(count),
        "mean_word": _sums(lengths, words.offsets) / some,
        "longest_word": np.log1p(longest),
        "distinct_words": _distinct(words.row, words.hashes, n) / some,
        "repeated_windows": 1 - _distinct(row, windows[whole], n) / np.maximum(n_windows, 1),
        "repeated_lines": 1 - _distinct(lines.row, lines.hashes, n) / n_lines,
        "words_per_line": np.log1p(count / n_lines),
        "stop_words": _sums(_STOP[at] == words.hashes, words.offsets) / some,
    }
    columns |= {name: _sums(members[data], offsets) / size for name, members in _CLASSES.items()}
    return np.stack([columns[name] for name in FEATURES], axis=1)


def _leaves(gain: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """A tree of the given depth over ordered bins: the step of each bin."""
    out = np.full(len(gain), gain.sum() / (weight.sum() + SHRINK))
    if depth and len(gain) > 1:
        g, w = np.cumsum(gain)[:-1], np.cumsum(weight)[:-1]
        rest_g, rest_w = gain.sum() - g, weight.sum() - w
        value = g**2 / (w + SHRINK) + rest_g**2 / (rest_w + SHRINK)
        at = int(value.argmax()) + 1
        out[:at], out[at:] = _leaves(gain[:at], weight[:at], depth - 1), _leaves(gain[at:], weight[at:], depth - 1)
    return out


def _cross(gain: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both axes of a table once: its worth and its steps."""
    best, out = -1.0, np.zeros_like(gain)
    g, w = gain.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    for i in range(gain.shape[0] - 1):
        for j in range(gain.shape[1] - 1):
            gs = np.array([g[i, j], g[i, -1] - g[i, j], g[-1, j] - g[i, j], g[-1, -1] - g[i, -1] - g[-1, j] + g[i, j]])
            ws = np.array([w[i, j], w[i, -1] - w[i, j], w[-1, j] - w[i, j], w[-1, -1] - w[i, -1] - w[-1, j] + w[i, j]])
            worth = float((gs**2 / (ws + SHRINK)).sum())
            if worth > best:
                best = worth
                step = gs / (ws + SHRINK)
                out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = step[0], step[1]
                out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = step[2], step[3]
    return best, out


@dataclass
class AdditiveModel:
    """Bin edges and a table for each feature, tables for pairs, and what every score begins with."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for f, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for (f, g), table in self.pairs.items():
            row = np.searchsorted(self.pair_edges[f], x[:, f], "right")
            out += table[row, np.searchsorted(self.pair_edges[g], x[:, g], "right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of the log-likelihood, first on single features, then on the pairs that gain most."""
    n_features = x.shape[1] if x.ndim == 2 else len(FEATURES)
    share = float(y.mean()) if len(y) else 0.5
    start = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    none = [np.zeros(0)] * n_features
    if len(y) == 0 or share in (0.0, 1.0):
        return AdditiveModel(start, none, [np.zeros(1)] * n_features, none, {})
    edges = [_edges(x[:, f], BINS) for f in range(n_features)]
    place = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    logit = np.full(len(y), start)
    for _ in range(ROUNDS):
        for f, at in enumerate(place):
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            n = len(tables[f])
            step = RATE * _leaves(np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n), 2)
            tables[f] += step
            logit += step[at]
    pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(n_features)]
    place = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(pair_edges)]
    size = [len(e) + 1 for e in pair_edges]

    def table(f: int, g: int) -> tuple[float, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        both, n = place[f] * size[g] + place[g], size[f] * size[g]
        gain, weight = np.bincount(both, y - p, n), np.bincount(both, p * (1 - p), n)
        return _cross(gain.reshape(size[f], size[g]), weight.reshape(size[f], size[g]))

    worth = {(f, g): table(f, g)[0] for f in range(n_features) for g in range(f) if min(size[f], size[g]) > 1}
    pairs = {k: np.zeros((size[k[0]], size[k[1]])) for k in sorted(worth, key=worth.get, reverse=True)[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for f, g in pairs:
            step = RATE * table(f, g)[1]
            pairs[f, g] += step
            logit += step[place[f], place[g]]
    return AdditiveModel(start, edges, tables, pair_edges, pairs)


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def training_rows(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """Measures and label of a bounded, repeatable sample of the labelled rows that are not held out."""
    usable = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (remainder("doc_id", 3) != 1)
    )
    share = min(1.0, TRAIN_ROWS / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # about TRAIN_ROWS short rows, whatever the size of the labels
    texts = _rows(df, id_col, text_col).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                x = measures(data, offsets)
                label = batch.column(2).slice(a, b - a)
                yield pa.RecordBatch.from_arrays([label, *map(pa.array, x.T)], ["label", *FEATURES])

    return texts.select("doc_id", "text", "label").mapInArrow(
        run, "label int, " + ", ".join(f"{f} double" for f in FEATURES)
    )


def fit_quality(df: DataFrame, labels: DataFrame, **names: str) -> AdditiveModel:
    rows = training_rows(df, labels, **names).toPandas().sort_values(["label", *FEATURES])
    return fit(rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float))


def score_quality(df: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, whether it is held out, score and prediction. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                score = model.scores(measures(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score)], ["doc_id", "score"])

    return _rows(df, id_col, text_col).mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
