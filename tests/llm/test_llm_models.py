"""Trained operators: held-out accuracy, gradients, and defined results on odd rows."""

import numpy as np
import pytest
from conftest_llm import SF_DIR
from pyspark.sql import functions as F

from pasarlens.llm import language_id, quality_gam

BIG = SF_DIR.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet")


def test_quality_separates_held_out_rows(spark, big, odd, empty):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = quality_gam.fit_quality(big, labels)
    scored = quality_gam.score_quality(big, model)
    known = scored.join(labels.select("doc_id", "quality"), "doc_id").where("held_out")
    right = known.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert known.count() > 80 and right >= 0.97
    odd_scores = quality_gam.score_quality(odd, model).collect()
    assert len(odd_scores) == odd.count() and all(0 <= r["score"] <= 1 for r in odd_scores)
    assert quality_gam.score_quality(empty, model).count() == 0


def test_quality_without_usable_labels(spark, big, empty):
    for rows in ([], [(0, None, 0)], [(0, 1, 0), (2, 1, 0), (None, 0, 0)]):
        labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
        scores = quality_gam.score_quality(big.limit(5), quality_gam.fit_quality(big, labels)).collect()
        assert len(scores) == 5 and all(0 <= r["score"] <= 1 for r in scores)


def test_quality_tables_learn_an_interaction():
    x = np.random.default_rng(1).random((4000, 2))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.9


def test_language_of_held_out_rows(big, odd, empty):
    net = language_id.fit_languages(big)
    found = language_id.label_languages(big, net).join(big.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97
    rows = language_id.label_languages(odd, net).collect()
    assert len(rows) == odd.count()
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {1, 2, 3, 8} <= und and 4 not in und
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.label_languages(empty, net).count() == 0
    kept = language_id.keep_known(odd, net, 0.35)
    assert kept.schema == odd.schema and kept.where("doc_id IN (1, 2, 3, 8) OR lang IS NULL").count() == 0


def test_every_labelled_language_is_learned(spark):
    rows = [(i, chr(0x4E00 + i % 250) * 40, f"l{i % 250:03}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(language_id.fit_languages(docs).languages) == 250


def test_training_pieces_come_from_the_whole_text(spark):
    text = "".join(chr(0x4E00 + i) for i in range(3200))
    docs = spark.createDataFrame([(i, text, "a") for i in range(8)], "doc_id bigint, text string, lang string")
    starts = sorted({ord(r["text"][0]) - 0x4E00 for r in language_id.training_texts(docs).collect()})
    assert starts[0] < 200 and starts[-1] > 2900 and len({s // 200 for s in starts}) == 16


def test_score_limit_keeps_clean_rows(big):
    net = language_id.fit_languages(big)
    kept = language_id.keep_known(big, net, language_id.score_limit(big, net))
    assert kept.count() >= 0.99 * big.where("regexp_like(text, '[[:alpha:]]|[^[:ascii:]]')").count()


def test_language_without_labels(odd):
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    net = language_id.fit_languages(nothing)
    assert {r["lang_pred"] for r in language_id.label_languages(odd, net).collect()} == {"und"}


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = language_id.new_network(["a", "b", "c"])
    x = rng.integers(0, 256, (6, 5))
    steps, back = range(6), range(5, -1, -1)
    y = np.array([0, 1, 2, 0, 1])

    def states(kept=(None, None)):
        return language_id._run(net.forward, x, steps, kept[0]), language_id._run(net.backward, x, back, kept[1])

    def loss():
        p = language_id._label(net, states())
        return float(-np.log(p[:, y, np.arange(5)].astype(float)).sum())

    kept = ({}, {})
    error = language_id._label(net, states(kept))
    error[:, y, np.arange(5)] -= 1
    u = language_id.UNITS
    ahead = language_id._through_time(net.forward, x, steps, kept[0], net.output[:, :u].T @ error)
    behind = language_id._through_time(net.backward, x, back, kept[1], net.output[:, u:].T @ error)
    used = x.ravel()[0]
    for direction, gradient in ((net.forward, ahead), (net.backward, behind)):
        for weights, got, at in (
            (direction.inputs, gradient[0], (2 * u + 1, used)),
            (direction.inputs, gradient[0], (0, used)),
            (direction.gates, gradient[1], (1, 2)),
            (direction.candidate, gradient[2], (2, 1)),
        ):
            old = weights[at]
            weights[at] = old + 1e-2
            high = loss()
            weights[at] = old - 1e-2
            low = loss()
            weights[at] = old
            assert abs((high - low) / 2e-2 - got[at]) < 2e-2 + 0.05 * abs(got[at])


def test_windows_hold_every_byte_once():
    data = np.arange(200, dtype=np.uint8)
    windows, row = language_id.window_bytes(data, np.array([0, 0, 70, 200]), 64)
    assert row.tolist() == [1, 1, 2, 2, 2]
    assert windows[windows != 256].tolist() == data.tolist()
