"""Language ID: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

A text is read in windows of ``WINDOW`` bytes (all of them; the last one is filled up). In each window one gated recurrent layer runs
forward and one backward; every position gets a probability for each language from both states, and a text's probabilities
are the means over its positions. Windows of many texts are stacked, so each step is one matrix product.

The network is fitted on the driver from about ``TRAIN_DOCS`` texts of every labelled language (``TRAIN_ROWS`` in all), chosen by a hash of
the id, with ``TRAIN_PIECES`` windows spread over the whole of each; labelling covers every text.

Results in special cases: a null text or one without a letter is ``und`` with score 0; a null id is passed on and not held out;
rows with a null language are not learned from; without any labelled row every text is ``und``; repeated rows are labelled each; an
empty table gives an empty result; other columns are ignored. Of equally probable languages the first by name is given; a text of any
length is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.quality_gam import remainder
from pasarlens.llm.scratch import bounded_batches, stored
from pasarlens.llm.text_arrays import pieces
from pasarlens.operators.selection import nth_smallest

WINDOW = 64
UNITS = 8
TRAIN_DOCS = 400
TRAIN_ROWS = 80_000
TRAIN_PIECES = 16
STEPS = 240
BATCH = 512
TRAIN_WINDOW = 32
LEARNING_RATE = 0.02
UNKNOWN = "und"
_STACK = 1536
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Direction:
    """Input values of each byte for the update, reset and candidate gates, and the weights of the state.

    States are kept as units by windows, so that every operation runs over long rows. Gates are linear between 0 and 1, the
    candidate is ``x / (1 + |x|)``: both are cheap and have simple gradients.
    """

    inputs: np.ndarray  # 3 units x 257; column 256 is the filling
    gates: np.ndarray  # 2 units x units
    candidate: np.ndarray  # units x units


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # languages x 2 units
    bias: np.ndarray  # languages x 1

    def parameters(self) -> list[np.ndarray]:
        return [
            *(getattr(d, k) for d in (self.forward, self.backward) for k in ("inputs", "gates", "candidate")),
            self.output,
            self.bias,
        ]


def new_network(languages: list[str], seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.3, shape).astype(np.float32)

    def one() -> Direction:
        return Direction(draw(3 * UNITS, 257), draw(2 * UNITS, UNITS), draw(UNITS, UNITS))

    return Network(languages, one(), one(), draw(len(languages), 2 * UNITS), np.zeros((len(languages), 1), np.float32))


def _run(direction: Direction, bytes_: np.ndarray, steps: range, kept: dict | None = None) -> np.ndarray:
    """States after each step (steps x units x windows); ``kept`` receives what backpropagation needs."""
    u = UNITS
    by_byte = np.ascontiguousarray(direction.inputs.T)
    states = np.empty((len(bytes_), u, bytes_.shape[1]), np.float32)
    state = np.zeros(states.shape[1:], np.float32)
    for t in steps:
        given = np.ascontiguousarray(by_byte[bytes_[t]].T)
        raw = direction.gates @ state
        raw += given[: 2 * u]
        raw *= 0.25
        raw += 0.5
        gates = np.clip(raw, 0, 1, out=raw)
        update, reset = gates[:u], gates[u:]
        before = direction.candidate @ (reset * state)
        before += given[2 * u :]
        fresh = before / (1 + np.abs(before))
        if kept is not None:
            kept[t] = (state, gates, fresh)
        state = np.multiply(state - fresh, update, out=states[t])
        state += fresh
    return states


def _label(net: Network, states: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Probabilities at each position: steps x languages x windows."""
    z = net.output[:, :UNITS] @ states[0]
    z += net.output[:, UNITS:] @ states[1]
    z += net.bias
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _through_time(direction: Direction, bytes_: np.ndarray, steps: range, kept: dict, error: np.ndarray):
    """Gradients of one direction; ``error`` is the loss's gradient by each state."""
    u = UNITS
    d_in, d_gates = np.zeros_like(direction.inputs), np.zeros_like(direction.gates)
    d_cand = np.zeros_like(direction.candidate)
    carried = np.zeros(error.shape[1:], np.float32)
    for t in reversed(steps):
        state, gates, fresh = kept[t]
        update, reset = gates[:u], gates[u:]
        d = error[t] + carried
        d_fresh = d * (1 - update) * (1 - np.abs(fresh)) ** 2
        d_held = direction.candidate.T @ d_fresh
        d_raw = np.concatenate([d * (state - fresh), d_held * state])
        d_raw *= 0.25 * ((gates > 0) & (gates < 1))
        d_gates += d_raw @ state.T
        d_cand += d_fresh @ (reset * state).T
        for i, row in enumerate(np.concatenate([d_raw, d_fresh])):
            d_in[i] += np.bincount(bytes_[t], row, 257)
        carried = d * update + d_held * reset + direction.gates.T @ d_raw
    return [d_in, d_gates, d_cand]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam over batches of windows drawn alike from all languages; every position has the window's label."""
    net = new_network(languages, seed)
    params = net.parameters()
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    length = windows.shape[1]
    onward, backward = range(length), range(length - 1, -1, -1)
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
        x, y = np.ascontiguousarray(windows[rows].T), labels[rows]
        a, b = {}, {}
        states = _run(net.forward, x, onward, a), _run(net.backward, x, backward, b)
        error = _label(net, states)
        error[:, y, np.arange(len(y))] -= 1
        error *= (x != 256)[:, None, :] / np.float32(x.size)
        d_out = np.concatenate([np.einsum("tkn,tun->ku", error, s) for s in states], axis=1)
        d_bias = error.sum((0, 2))[:, None]
        ahead = _through_time(net.forward, x, onward, a, net.output[:, :UNITS].T @ error)
        back = _through_time(net.backward, x, backward, b, net.output[:, UNITS:].T @ error)
        rate = LEARNING_RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for q, g, m, v in zip(params, [*ahead, *back, d_out, d_bias], first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def window_bytes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, the last of each filled up with 256, and the text of each."""
    count = -(-np.diff(offsets) // width)
    row = np.repeat(np.arange(len(count)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[row] + number * width
    at = begin[:, None] + np.arange(width)
    beyond = at >= offsets[row + 1][:, None]
    out = data[np.minimum(at, max(0, len(data) - 1))].astype(np.int16) if len(data) else np.zeros(at.shape, np.int16)
    out[beyond] = 256
    return out, row


def probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The mean probabilities of each text, over all its positions (zeros for an empty text)."""
    total = np.zeros((len(offsets) - 1, len(net.languages)))
    windows, row = window_bytes(data, offsets, WINDOW)
    onward, backward = range(WINDOW), range(WINDOW - 1, -1, -1)
    for a in range(0, len(windows), _STACK):
        x, own = np.ascontiguousarray(windows[a : a + _STACK].T), row[a : a + _STACK]
        p = _label(net, (_run(net.forward, x, onward), _run(net.backward, x, backward)))
        filled = np.flatnonzero(x[-1] == 256)
        p[:, :, filled] *= (x[:, filled] != 256)[:, None, :]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        total[own[first]] += np.add.reduceat(p.sum(0).T, first)
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def _rows(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def _labelled(df: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"))
    return rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull())


def training_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Language and pieces of the labelled texts learned from: about ``TRAIN_DOCS`` texts of each language that are not held out (all, if
    there are fewer; fewer of each, if there are more than ``TRAIN_ROWS`` in all). A share by hash of the id, so no language's rows meet in one
    task. A text gives ``TRAIN_PIECES`` pieces spread over its whole length, at places chosen by hash."""
    labelled = _labelled(df, id_col, lang_col).where(remainder("doc_id", 4) != 2)
    counts = stored(labelled.groupBy("lang").count(), "languages")
    each = min(TRAIN_DOCS, TRAIN_ROWS // max(1, counts.count()) or 1)
    share = F.lit(float(each << 30)) / F.col("count")
    chosen = labelled.join(counts, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    # about TRAIN_ROWS pairs of an id and a language, so that the texts stay where they are
    chosen = F.broadcast(stored(chosen.select("doc_id", "lang").distinct(), "chosen"))
    texts = _rows(df, id_col, text_col).where("text IS NOT NULL").join(chosen, "doc_id")
    spare = F.greatest(F.char_length("text") - TRAIN_WINDOW, F.lit(0))
    # one place in each of equal parts of the text
    drawn = texts.select("lang", "text", spare.alias("spare"), F.explode(F.sequence(F.lit(0), F.lit(TRAIN_PIECES - 1))).alias("i"), "doc_id")
    within = F.pmod(F.xxhash64("doc_id", "i"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    start = F.floor((F.col("i") + within) * F.col("spare") / TRAIN_PIECES).cast("int") + 1
    # equal rows give equal pieces, which count once
    return drawn.select("lang", F.substring(F.col("text"), start, F.lit(TRAIN_WINDOW)).alias("text")).distinct()


def score_limit(
    df: DataFrame, net: Network, wrong: float = 0.002, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> float:
    """The score that all but a share of ``wrong`` of rightly labelled texts reach, exactly, over all labelled texts that were held out of
    the training. So it follows the number of languages; without any such text it is the score of a guess."""
    rows = _rows(df.withColumn("_lang", F.col(lang_col).cast("string")), id_col, text_col, "_lang")
    held_out = rows.where((remainder("doc_id", 4) == 2) & F.col("_lang").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, languages, score in _labels(net, batch.column(0)):
                own = batch.column(1).slice(a, len(score)).to_pylist()
                right = [s for s, found, lang in zip(score, languages, own, strict=True) if found == lang]
                yield pa.RecordBatch.from_arrays([pa.array(right, pa.float64())], ["score"])

    # one number per text, stored: its rank is found by counting
    scores = stored(held_out.select("text", "_lang").mapInArrow(run, "score double"), "held_out_scores")
    n = scores.count()
    if not n:
        return 1.0 / max(1, len(net.languages))
    return nth_smallest(scores, F.col("score"), [max(1, ceil(wrong * n)) - 1], 0.0, 1.0)[0]


def fit_languages(df: DataFrame, **names: str) -> Network:
    """The network for the languages of the labelled rows (none of them: no languages)."""
    rows = sorted({(r["lang"], r["text"]) for r in training_texts(df, **names).collect() if _LETTER.search(r["text"])})
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return new_network([])
    coded = [text.encode() for _, text in rows]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in coded])])
    windows, row = window_bytes(np.frombuffer(b"".join(coded), np.uint8), offsets, TRAIN_WINDOW)
    labels = np.searchsorted(languages, [lang for lang, _ in rows])
    return train(windows, labels[row], languages)


def _labels(net: Network, column: pa.Array) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """First row, languages and their probabilities for slices of a column of texts."""
    names = np.array([*net.languages, UNKNOWN], object)
    for a, b, data, offsets in pieces(column):
        texts = column.slice(a, b - a).to_pylist()
        if not net.languages:
            yield a, [UNKNOWN] * len(texts), np.zeros(len(texts))
            continue
        p = probabilities(net, data, offsets)
        known = np.array([bool(t and _LETTER.search(t)) for t in texts])
        best = np.where(known, p.argmax(1), len(net.languages))
        yield a, names[best].tolist(), np.where(known, np.clip(p.max(1), 0, 1), 0.0)


def label_languages(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, whether it is held out, language and its probability. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, languages, score in _labels(net, batch.column(1)):
                own = [batch.column(0).slice(a, len(score)), pa.array(languages, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(own, ["doc_id", "lang_pred", "score"])

    labelled = _rows(df, id_col, text_col).mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return labelled.select("doc_id", held_out, "lang_pred", "score")


def keep_known(df: DataFrame, net: Network, least: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is known with probability ``least`` or more, with all columns; a null language is filled in."""
    bounded_batches(df.sparkSession)
    text, lang = df.columns.index(text_col), df.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, languages, score in _labels(net, batch.column(text)):
                rows = batch.slice(a, len(score))
                filled = pa.array(
                    [own or found for own, found in zip(rows.column(lang).to_pylist(), languages, strict=True)], pa.string()
                )
                rows = rows.set_column(lang, batch.schema.field(lang), filled)
                yield rows.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(languages, score, strict=True)]))

    return df.mapInArrow(run, df.schema)
