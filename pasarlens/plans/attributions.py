"""What each input adds to a prediction: Shapley values of the fitted models, by row and on average.

For trees the value of a set of inputs is the mean over the leaves that a row can reach if only these inputs are known, weighted by
the training rows on either side of the other splits (path-dependent Shapley values). They are exact: a leaf depends only on
the few inputs on its path, so the share of each is tabulated for every combination of fulfilled conditions, and a row looks up
the combination that it fulfils. For the linear model they are the coefficients times the distance from the mean. The
attributions of a row and the base value add up to its prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.session import fresh_path

SCHEMA = "base double, attributions array<double>"


@dataclass(frozen=True)
class Split:
    """A condition on an input: at most ``threshold``, or one of ``categories``; ``met`` says which outcome leads on."""

    feature: int
    threshold: float | None
    categories: frozenset[float] | None
    met: bool


@dataclass(frozen=True)
class Leaf:
    """A weighted leaf: its inputs, the splits on each, each input's share of training rows that go this way, and the value."""

    features: tuple[int, ...]
    splits: tuple[tuple[Split, ...], ...]
    shares: tuple[float, ...]
    value: float


def tree_leaves(nodes: dict[int, dict], weight: float = 1.0) -> list[Leaf]:
    """All leaves of a stored tree. ``nodes`` has, by id, ``prediction``, ``rows``, ``left``, ``right`` (negative: a leaf), ``feature``,
    ``values`` (threshold or left categories) and ``categories`` (their number, negative: a threshold)."""
    out = []
    todo: list[tuple[int, dict[int, tuple[tuple[Split, ...], float]]]] = [(0, {})]
    while todo:
        at, path = todo.pop()
        node = nodes[at]
        if node["left"] < 0:
            features = tuple(path)
            out.append(
                Leaf(features, tuple(path[f][0] for f in features), tuple(path[f][1] for f in features), weight * node["prediction"])
            )
            continue
        continuous = node["categories"] < 0
        for child, met in ((node["left"], True), (node["right"], False)):
            split = Split(
                node["feature"], node["values"][0] if continuous else None, None if continuous else frozenset(node["values"]), met
            )
            splits, share = path.get(split.feature, ((), 1.0))
            share *= nodes[child]["rows"] / node["rows"]
            todo.append((child, path | {split.feature: ((*splits, split), share)}))
    return out


def shares_by_pattern(shares: tuple[float, ...], value: float) -> np.ndarray:
    """For every pattern of fulfilled inputs (as bits): what each input of a leaf adds."""
    d = len(shares)
    out = np.zeros((1 << d, d))
    for pattern in range(1 << d):
        known = [float(pattern >> j & 1) for j in range(d)]
        for i in range(d):
            others = [j for j in range(d) if j != i]
            total = 0.0
            for size in range(d):
                weight = factorial(size) * factorial(d - size - 1) / factorial(d)
                for chosen in combinations(others, size):
                    total += weight * np.prod([known[j] if j in chosen else shares[j] for j in others])
            out[pattern, i] = value * total * (known[i] - shares[i])
    return out


class TreeAttributions:
    """Attributions of a sum of trees for rows of a feature matrix."""

    def __init__(self, leaves: list[Leaf]):
        self.leaves = leaves
        self.base = sum(leaf.value * float(np.prod(leaf.shares)) for leaf in leaves)
        self.tables = [shares_by_pattern(leaf.shares, leaf.value) for leaf in leaves]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape)
        outcome: dict[tuple, np.ndarray] = {}
        for leaf, table in zip(self.leaves, self.tables, strict=True):
            pattern = np.zeros(len(x), np.int64)
            for j, splits in enumerate(leaf.splits):
                met = np.ones(len(x), bool)
                for s in splits:
                    key = (s.feature, s.threshold, s.categories)
                    if key not in outcome:
                        column = x[:, s.feature]
                        outcome[key] = np.isin(column, list(s.categories)) if s.threshold is None else column <= s.threshold
                    met &= outcome[key] == s.met
                pattern |= met.astype(np.int64) << j
            for j, feature in enumerate(leaf.features):
                out[:, feature] += table[pattern, j]
        return out


def stored_leaves(model: PipelineModel, rows: DataFrame) -> list[Leaf]:
    """The leaves of a boosted-tree model, read from its stored form: as many as the model has, whatever it was trained on."""
    trees = model.stages[-1]
    path = fresh_path(rows.sparkSession, "trees")
    trees.write().save(path)
    n = F.col("nodeData")
    stored = rows.sparkSession.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["prediction"].alias("prediction"), n["rawCount"].alias("rows"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
        n["split"]["leftCategoriesOrThreshold"].alias("values"), n["split"]["numCategories"].alias("categories"),
    )
    nodes: dict[int, dict[int, dict]] = {}
    for row in stored.collect():
        nodes.setdefault(row["treeID"], {})[row["id"]] = row.asDict()
    weights = trees.treeWeights
    return [leaf for tree in sorted(nodes) for leaf in tree_leaves(nodes[tree], weights[tree])]


def _features(model: PipelineModel, rows: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """``keep``, the prediction and the model's inputs as an array, and the name of the column behind each input."""
    scored = model.transform(rows)
    attributes = scored.schema["features"].metadata["ml_attr"]["attrs"]
    listed = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    names = [listed[i] for i in range(len(listed))]
    for column in model.stages[-2].getInputCols():
        own = column.removesuffix("_filled").removesuffix("_hot").removesuffix("_index")
        names = [own if n == column or n.startswith(f"{column}_") else n for n in names]
    return scored.select(*keep, "prediction", vector_to_array("features").alias("features")), names


def tree_attributions(model: PipelineModel, rows: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """``keep``, ``prediction``, ``base`` and ``attributions`` of each row, and the column behind each attribution."""
    explain = TreeAttributions(stored_leaves(model, rows))
    scored, names = _features(model, rows, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = len(keep) + 1
        for batch in batches:
            x = batch.column(place).flatten().to_numpy().reshape(batch.num_rows, len(names))
            values = pa.array(explain(x).ravel())
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(names))
            columns = [*batch.columns[:place], pa.array(np.full(batch.num_rows, explain.base))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(ends, values)], [*keep, "prediction", "base", "attributions"]
            )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in scored.schema if f.name != "features")
    return scored.mapInArrow(run, kinds + SCHEMA), names


def linear_attributions(model: PipelineModel, rows: DataFrame, training: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """The same for the linear model; an input's expectation is its mean over the training rows."""
    fitted = model.stages[-1]
    means = model.transform(training).agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    weights = fitted.coefficients.toArray()
    base = float(fitted.intercept + weights @ means)
    scored, names = _features(model, rows, keep)
    pairs = F.arrays_zip(
        F.col("features").alias("x"), F.lit(weights.tolist()).alias("w"), F.lit(means.tolist()).alias("m")
    )
    values = F.transform(pairs, lambda p: p["w"] * (p["x"] - p["m"]))
    return scored.select(*keep, "prediction", F.lit(base).alias("base"), values.alias("attributions")), names


def adds_up(tolerance: float = 1e-6) -> Column:
    """Whether base and attributions of a row make its prediction."""
    total = F.aggregate("attributions", F.col("base"), lambda a, x: a + x)
    return F.abs(total - F.col("prediction")) <= tolerance * (1 + F.abs("prediction"))


def global_attributions(attributed: DataFrame, names: list[str]) -> DataFrame:
    """``feature`` and ``attribution``, the mean absolute attribution over the rows, largest first. The parts of a column that became
    several inputs are added up in each row first."""
    columns = list(dict.fromkeys(names))

    def of(column: str) -> Column:
        places = [F.col("attributions")[i] for i, n in enumerate(names) if n == column]
        return F.avg(F.abs(reduce(lambda a, b: a + b, places)))

    one = attributed.agg(*[of(c).alias(c) for c in columns])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("attribution")) for c in columns]))
    return one.select(each.alias("x")).select("x.*").orderBy(F.desc("attribution"), "feature")
