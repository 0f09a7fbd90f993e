"""The limit of the language stage."""

from math import ceil

from pasarlens.llm import language_id


def test_score_limit_is_the_exact_rank_over_all_held_out_rows(spark):
    rows = [(i, f"some words number {i} of a text", "en") for i in range(20_000)] + [(i, f"ein paar worte {i} im text", "de") for i in range(20_000, 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_id.new_network(["de", "en"])
    labelled = language_id.label_languages(docs, net).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    scores = sorted(r["score"] for r in labelled.where("lang_pred = lang").collect())
    assert language_id.score_limit(docs, net, 0.1) == scores[max(1, ceil(0.1 * len(scores))) - 1]
