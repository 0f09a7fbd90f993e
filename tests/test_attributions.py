"""Shapley values against sums over all subsets, and of fitted models."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from pasarlens.plans import attributions as a


def random_tree(rng, depth, features):
    nodes = {}

    def grow(level, rows):
        own = len(nodes)
        nodes[own] = {"prediction": float(rng.normal()), "rows": rows, "left": -1, "right": -1, "feature": -1, "values": [], "categories": -1}
        if level and rows > 1:
            left = int(rng.integers(1, rows))
            feature = int(rng.integers(features))
            nodes[own] |= {"feature": feature, "values": [float(rng.random())]}
            if feature == 0:
                nodes[own] |= {"values": sorted(rng.choice(4, 2, replace=False).astype(float).tolist()), "categories": 4}
            nodes[own]["left"] = grow(level - 1, left)
            nodes[own]["right"] = grow(level - 1, rows - left)
        return own

    grow(depth, 100)
    return nodes


def expected(nodes, x, known, at=0):
    """Value of a tree if only the known inputs are."""
    node = nodes[at]
    if node["left"] < 0:
        return node["prediction"]
    if node["feature"] in known:
        value = x[node["feature"]]
        goes_left = value <= node["values"][0] if node["categories"] < 0 else value in node["values"]
        return expected(nodes, x, known, node["left"] if goes_left else node["right"])
    parts = [(nodes[c]["rows"] / node["rows"], c) for c in (node["left"], node["right"])]
    return sum(share * expected(nodes, x, known, c) for share, c in parts)


def by_subsets(nodes, x):
    m, out = len(x), []
    for i in range(m):
        others = [j for j in range(m) if j != i]
        total = 0.0
        for size in range(m):
            for chosen in combinations(others, size):
                weight = factorial(size) * factorial(m - size - 1) / factorial(m)
                total += weight * (expected(nodes, x, {*chosen, i}) - expected(nodes, x, set(chosen)))
        out.append(total)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_tree_attributions_equal_sums_over_subsets(seed):
    rng = np.random.default_rng(seed)
    trees = [(random_tree(rng, 4, 4), w) for w in (1.0, 0.1)]
    explain = a.TreeAttributions([leaf for nodes, w in trees for leaf in a.tree_leaves(nodes, w)])
    x = rng.random((12, 4))
    x[:, 0] = rng.integers(0, 4, 12)
    got = explain(x)
    for row, values in zip(x, got, strict=True):
        plain = sum(w * np.array(by_subsets(nodes, row)) for nodes, w in trees)
        assert np.allclose(values, plain)
        assert np.isclose(values.sum() + explain.base, sum(w * expected(n, row, set(range(4))) for n, w in trees))


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(400).select(
        i, (i % 7).cast("double").alias("a"), ((i * 7919) % 101).cast("double").alias("b"), F.concat(F.lit("c"), i % 4).alias("c"),
        ((i % 7) * 3 + (i % 4) * 10 + i % 3).cast("double").alias("label"),
    )


def test_attributions_of_fitted_trees(spark, rows):
    stages = [StringIndexer(inputCol="c", outputCol="c_index"), VectorAssembler(inputCols=["a", "b", "c_index"], outputCol="features"),
              GBTRegressor(maxIter=8, maxDepth=4, stepSize=0.3, seed=1)]
    model = Pipeline(stages=stages).fit(rows)
    found, names = a.tree_attributions(model, rows.repartition(3), ["id"])
    assert names == ["a", "b", "c"] and found.count() == 400
    assert found.where(~a.adds_up(1e-9)).count() == 0
    means = {r["feature"]: r["attribution"] for r in a.global_attributions(found, names).collect()}
    assert list(means)[:2] == ["c", "a"] and means["b"] < 1 < means["a"] < means["c"]
    assert a.tree_attributions(model, rows.where("false"), ["id"])[0].count() == 0


def test_attributions_of_the_linear_model(spark, rows):
    stages = [StringIndexer(inputCol="c", outputCol="c_index"), OneHotEncoder(inputCol="c_index", outputCol="c_hot"),
              VectorAssembler(inputCols=["a", "b", "c_hot"], outputCol="features"), LinearRegression()]
    model = Pipeline(stages=stages).fit(rows)
    found, names = a.linear_attributions(model, rows.where("id < 50"), rows, ["id"])
    assert names == ["a", "b", "c", "c", "c"]
    assert found.where(~a.adds_up(1e-9)).count() == 0
    mean = rows.agg(F.avg("a")).first()[0]
    weight = model.stages[-1].coefficients[0]
    assert all(r["attributions"][0] == pytest.approx(weight * (r["id"] % 7 - mean)) for r in found.collect())
    # over the training rows every attribution has mean zero
    every = a.linear_attributions(model, rows, rows, ["id"])[0]
    assert every.agg(F.avg(F.col("attributions")[0])).first()[0] == pytest.approx(0, abs=1e-9)
