"""Operators that compare texts or vectors, against plain versions."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import SF_DIR, pairs
from pyspark.sql import functions as F

import corpus_pipeline
from pasarlens.llm import exact_topk, graphs, ngram_join, substring_dedup
from pasarlens.llm.scratch import stored

BLANKS = "\t\n\x0b\x0c\r"


def words_of(text):
    for c in BLANKS:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_removal(rows):
    """doc_id and text -> n_words, n_removed, kept."""
    first = {}
    for doc, text in rows:
        w = words_of(text or "")
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words_of(text or "")
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def passages(seed, n=60):
    """Texts from a small stock of passages, some of them changed, with very frequent words between them."""
    rng = random.Random(seed)
    stock = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(rng.randint(5, 40))) for _ in range(8)]
    rows = []
    for doc in range(n):
        parts = [rng.choice(stock) for _ in range(rng.randint(0, 4))]
        w = words_of(" x ".join(parts))
        for _ in range(rng.randint(0, 2)):
            if w:
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 5)}"
        rows.append((doc, rng.choice([" ", "\n", " \t"]).join(w)))
    return rows


def removed(df):
    rows = substring_dedup.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("frequent", [1000, 3])
def test_removal_equals_a_plain_version(spark, monkeypatch, frequent):
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    rows = passages(frequent)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert removed(df) == sorted(plain_removal(rows), key=str)


@pytest.mark.parametrize("rows", [0, 1 << 20])
def test_removal_with_a_table_that_is_joined_or_broadcast(spark, documents, monkeypatch, rows):
    expected = removed(documents)
    monkeypatch.setattr(substring_dedup, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(substring_dedup, "LEAST_WORDS", 1 << 8)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 1 << 12)
    assert removed(documents) == expected


def test_table_and_buckets_grow_with_the_input():
    assert substring_dedup._bucket_count(0) == 64 and substring_dedup._bucket_count(1 << 47) == 1 << 23
    for repeated in (0, 1, 1 << 22, (1 << 22) + 1, 10**9, 10**12):
        words = substring_dedup._table_words(repeated)
        assert words >= 1 << 20 and repeated <= words * substring_dedup.REPEATED_A_WORD
        assert words == 1 << 20 or words * substring_dedup.REPEATED_A_WORD <= 3 * repeated


def test_removal_on_given_documents_and_rows_that_share_ids(spark, documents, odd):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows += [(rows[3][0], rows[9][1]), (rows[9][0], rows[9][1]), (rows[50][0], rows[2][1] + " " + rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert removed(df) == sorted(plain_removal(rows), key=str)


def test_removal_of_odd_rows(odd, empty):
    rows = substring_dedup.remove_repeats(odd, carry=True)
    assert rows.count() == odd.count()
    by_id = pairs(rows.collect(), "doc_id")
    assert all(r["n_removed"] == 0 for r in by_id[None])
    assert [r["n_removed"] for r in by_id[4]] == [0, 0] and by_id[5][0]["n_removed"] == by_id[5][0]["n_words"]
    assert by_id[1][0]["kept"] == "" and by_id[7][0]["n_words"] == 180_000
    assert by_id[5][0]["rest"]["source"] == "a" and by_id[5][0]["rest"]["kept"] == "other"
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_removal_of_a_row_repeated_many_times(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 50)
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:20], "new", *words[21:]])), (3, "no words in common")]
    rows += [(9, " ".join(["x", *words, "y"]))] * 200 + [(9, " ".join(words[:15]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    held = []
    listed = substring_dedup._listed

    def kept(spans, name, shared):
        held.append(listed(spans, name, shared))
        return held[-1]

    monkeypatch.setattr(substring_dedup, "_listed", kept)
    assert removed(df) == sorted(plain_removal(rows), key=str)
    for lists in held:
        column = lists.columns[-1]
        assert lists.count() > 0 and lists.where(F.size(column) > 42).count() == 0


def shingles_of(text):
    w = words_of(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows):
    sets = [(doc, shingles_of(text)) for doc, text in rows]
    links = [[j for j, (_, b) in enumerate(sets) if i != j and a and b and 10 * len(a & b) >= 8 * len(a | b)]
             for i, (_, a) in enumerate(sets)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, own in enumerate(links):
            least = min([label[i], *(label[j] for j in own)], key=lambda k: rows[k][0])
            changed |= label[i] != least
            label[i] = least
    return sorted((rows[i][0], rows[label[i]][0], len(links[i])) for i in range(len(rows)))


def near_copies(seed, n=150):
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 6, 40, 120]))] for _ in range(6)]
    rows = []
    for doc in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 30)}"
        rows.append((doc, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_links_equal_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    rows = near_copies(block)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, ngram_join.near_duplicates(df).select("doc_id", "class_id", "n_links").collect()))
    assert got == plain_classes(rows)


def test_links_of_repeated_rows_with_a_near_copy(spark):
    words = [f"w{i}" for i in range(60)]
    near, far = [*words[:59], "new"], [f"v{i}" for i in range(60)]
    rows = [(5, words), (5, words), (7, near), (8, far), (8, words), (8, ["other"])]
    rows = [(doc, " ".join(w)) for doc, w in rows] + [(9, " ".join([*far[:59], str(i)])) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, ngram_join.near_duplicates(df).collect()))
    # rows that share an id are in one class
    assert got == sorted((doc, 5, n) for doc, _, n in plain_classes(rows))
    few = spark.createDataFrame(rows[:3], "doc_id bigint, text string")
    assert sorted(map(tuple, ngram_join.near_duplicates(few).collect())) == [(5, 5, 2), (5, 5, 2), (7, 5, 2)]


def test_links_of_odd_rows(odd, empty):
    got = pairs(ngram_join.near_duplicates(odd).collect(), "doc_id")
    assert sum(map(len, got.values())) == odd.count()
    assert {(r["class_id"], r["n_links"]) for r in got[None]} == {(None, 0)}
    assert {(r["class_id"], r["n_links"]) for r in got[4] + got[5]} == {(4, 2)}
    assert all((r["class_id"], r["n_links"]) == (d, 0) for d in (1, 2, 3, 7) for r in got[d])
    assert ngram_join.near_duplicates(empty).count() == 0


def test_pruning_keeps_what_can_reach_the_threshold():
    for n, least in ngram_join.least_matches():
        below = sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(least))
        assert below < ngram_join.TOLERANCE


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, 900, dtype=np.int64).astype(np.uint64)
    sets = [np.sort(values[:600]), np.sort(values[60:660])]
    row = np.repeat([0, 1], 600)
    found = ngram_join.signatures(row, np.concatenate(sets), 2)
    assert abs((found[0] == found[1]).mean() - 540 / 660) < 0.15


def test_components_of_a_path_and_a_star(spark):
    rng = random.Random(4)
    path = list(range(100, 160))
    rng.shuffle(path)
    edges = [*zip(path, path[1:], strict=False), *[(7, x) for x in range(200, 260)], (3, 3), (5, 9), (9, 5)]
    got = graphs.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    expected = {**dict.fromkeys(path, 100), **dict.fromkeys([7, *range(200, 260)], 7), 5: 5, 9: 5}
    assert {r["node"]: r["component"] for r in got.collect()} == expected and got.count() == len(expected)
    assert graphs.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_topk(rows, every, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in usable:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in usable if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block", [128, 4])
def test_topk_equals_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(exact_topk, "SHARD_BLOCKS", 3)
    monkeypatch.setattr(exact_topk, "QUERY_GROUP", 7)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + 0.3 * rng.normal(size=8)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]
    rows += [(400, None), (401, []), (402, [None] * 8), (None, rows[0][1]), (404, [float("nan")] * 8), (405, [1.0, 2.0, 3.0]),
             (406, [math.inf] * 8), (407, [3e7] * 8), (410, [-3e7, 3e7])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("other"))
    got = exact_topk.exact_topk(df.repartition(4), every=10)
    assert sorted(map(tuple, got.collect())) == plain_topk(rows, 10, 5)


def test_topk_keeps_the_lowest_scores(spark):
    kind = "vec_id bigint, embedding array<double>"
    rows = [(0, [1e7]), (1, [-1e7]), (2, [1.0]), (3, [-1e30]), (4, [-2e30])]
    got = exact_topk.exact_topk(spark.createDataFrame(rows, kind).repartition(3), every=50)
    low, least = math.floor(256e7) * math.floor(-256e7), -(2**63)
    assert low > least
    expected = [(0, 1, 2, 256 * math.floor(256e7)), (0, 2, 1, low), (0, 3, 3, least), (0, 4, 4, least)]
    assert sorted(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("block", [1, 2])
def test_topk_of_terms_that_cancel(spark, monkeypatch, block):
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    big = 1e6
    rows = [(i, [big * (1 + i % 3), big * (1 + i % 3) * (-1) ** i, float(rng.integers(-5, 6))]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, exact_topk.exact_topk(df, every=20).collect())) == plain_topk(rows, 20, 5)


def morse(length, a, b):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(length))


def test_texts_in_thue_morse_order_are_told_apart(spark):
    """Words and word orders that every polynomial hash modulo a power of two confuses."""
    n = 1024
    letters = [" ".join([morse(n, *x), *[f"w{i}" for i in range(14)]]) for x in ("ab", "ba")]
    spelt = [" ".join(morse(2 * n, *x)) for x in ("ab", "ba")]
    rows = [(1, letters[0]), (2, letters[1]), (3, spelt[0]), (4, spelt[1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = sorted(plain_removal(rows))
    left = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, left.collect())) == expected
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == {d: (c, n) for d, c, n in plain_classes(rows)}


def test_topk_of_few_rows_and_repeats(spark, empty):
    kind = "vec_id bigint, embedding array<float>"
    assert exact_topk.exact_topk(spark.createDataFrame([], kind)).count() == 0
    assert exact_topk.exact_topk(spark.createDataFrame([(0, [1.0])], kind)).count() == 0
    rows = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0])], kind)
    assert sorted(map(tuple, exact_topk.exact_topk(rows).collect())) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]


def test_pipeline_stages(spark, documents, odd):
    ids = odd.where("doc_id IS NOT NULL").select(F.max("doc_id")).first()[0] + 1
    own = odd.select(documents.columns)
    docs = documents.withColumn("doc_id", F.col("doc_id") + ids).unionByName(own)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        if name != "packing":
            assert docs.columns == before.columns
        if name == "language_id":
            assert docs.where("text IS NULL OR doc_id IN (1, 2, 3, 8)").count() == 0
            assert docs.count() >= 0.97 * documents.count()
        if name == "ngram_join":
            expected = {c for _, c, _ in plain_classes([(r["doc_id"], r["text"]) for r in before.collect() if r["doc_id"] is not None])}
            # a class by ids holds at least one class of texts: rows that share an id stay apart unless their texts are linked
            kept = [(r["doc_id"], r["text"]) for r in docs.where("doc_id IS NOT NULL").collect()]
            assert {d for d, _ in kept} == expected and len(set(kept)) == len(kept)
            apart = sorted(r["text"] for r in before.where("doc_id = 6").collect())
            assert sorted(t for d, t in kept if d == 6) == apart
            assert len(kept) == len(expected) + max(0, len(apart) - 1)
            assert docs.where("doc_id IS NULL").count() == before.where("doc_id IS NULL").count()
        if name == "substring_dedup":
            left = {r["doc_id"]: r["text"] for r in docs.where("doc_id IS NOT NULL").collect()}
            rows = [(r["doc_id"], r["text"]) for r in before.where("doc_id IS NOT NULL").collect()]
            assert {d: " ".join(words_of(t)) for d, t in left.items()} == {d: kept for d, _, _, kept in plain_removal(rows)}
            assert docs.where("n_chars <> char_length(text)").count() == 0
        if name == "pii":
            assert docs.count() == before.count()
    assert docs.where("piece = 0").count() == before.count()


def test_pipeline_judges_rows_that_share_an_id_by_their_texts(spark):
    def text(letter, *changed):
        return " ".join([*[f"{letter}{i}" for i in range(60)], *changed])

    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (1, text("c")), (2, text("a", "x")), (2, text("d")), (3, text("c")),
            (3, text("e")), (4, text("e", "y")), (None, text("a"))]
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id bigint, text string, lang string").repartition(3)
    left = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    expected = [(1, text("a")), (1, text("b")), (1, text("c")), (2, text("d")), (3, text("e")), (None, text("a"))]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(expected, key=str)
    assert "WindowGroupLimit" in left._jdf.queryExecution().executedPlan().toString()
    docs = stored(left, "left")
    for name, stage in corpus_pipeline.STAGES[2:]:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        if name == "substring_dedup":
            expected = plain_removal([(r["doc_id"], r["text"]) for r in before.where("doc_id IS NOT NULL").collect()])
            got = [(r["doc_id"], " ".join(words_of(r["text"]))) for r in docs.where("doc_id IS NOT NULL").collect()]
            assert sorted(got) == sorted((d, t) for d, _, _, t in expected)
    assert docs.where("piece = 0").count() == before.count() == 6


def test_pipeline_on_an_empty_table(spark, empty):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
    assert docs.count() == 0


def test_strings_from_buffers():
    text = substring_dedup._strings(np.frombuffer(b"abcd", np.uint8), np.array([0, 1, 1, 4]))
    assert text == pa.array(["a", "", "bcd"]) and hashlib.sha256(text[2].as_py().encode()).hexdigest()
