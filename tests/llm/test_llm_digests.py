"""Spelling variants, Merkle manifest and exact dedup: equal to plain versions, and defined results on odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD_ROWS, SCHEMA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import difference
from pasarlens.llm import exact_dedup, merkle, spelling, sql


def database(df):
    db = duckdb.connect()
    db.register("rows", df.toArrow())
    db.execute("CREATE TABLE documents AS SELECT * FROM rows")
    return db


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\u0080" else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    form, out = {}, []
    for w, n in words.items():
        others = [x for x in words if x != w and near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
        out.append([w, form[w], None, n, len(others), words[form[w]] if form[w] else None])
    for row in out:
        root = row[0]
        while form[root]:
            root = form[root]
        row[2] = root
    return sorted((tuple(r) for r in out), key=lambda r: r[0])


def groups(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def misspelt(spark):
    """Words of few letters with many variants, of which some are long and some share all halves; extra columns."""
    rng = random.Random(4)
    base = ["".join(rng.choices("abé", k=rng.randint(4, 9))) for _ in range(60)] + ["x" * 300, "x" * 150 + "y" + "x" * 149]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(base)
            at = rng.randrange(len(w))
            if rng.random() < 0.5:
                w = w[:at] + rng.choice(["", "b", "ÿ" + w[at]]) + w[at + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((None if i % 50 == 49 else i, rng.choice([" ", "1", "-"]).join(words)))
    docs = spark.createDataFrame([*rows, *rows[:3], (1, None), (2, "")], "doc_id bigint, text string")
    return docs.select("*", *[F.lit("other").alias(c) for c in ("word", "n", "size", "half", "form")])


@pytest.mark.parametrize("cell", [spelling.CELL_WORDS, 8])
def test_spelling_equals_a_plain_version(misspelt, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    expected = plain_groups(plain_words([(r["doc_id"], r["text"]) for r in misspelt.select("doc_id", "text").collect()]))
    assert len(expected) > 200 and any(r[1] != r[2] for r in expected if r[1])
    assert groups(spelling.spelling_groups(misspelt.repartition(5))) == expected


def test_spelling_of_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert groups(spelling.spelling_groups(odd)) == plain_groups(plain_words(rows))
    assert spelling.spelling_groups(empty).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abü", min_size=3, max_size=6), min_size=1, max_size=90, unique=True), st.integers(0, 3))
def test_position_index_finds_single_errors(words, cut):
    index = spelling.PositionIndex(words)
    for size in {len(w) for w in words}:
        asks = [w for w in words if len(w) == size]
        found, begins = index.near(asks, cut)
        bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, : len(words)]
        same = np.unpackbits(begins.view(np.uint8), axis=1, bitorder="little")[:, : len(words)]
        for i, w in enumerate(asks):
            assert [words[j] for j in np.flatnonzero(bits[i])] == [x for x in words if near(w, x)]
            assert [words[j] for j in np.flatnonzero(same[i])] == [x for x in words if x[:cut] == w[:cut]]


def test_roots_of_a_long_chain(spark):
    names = [f"w{i:03}" for i in range(40)]
    forms = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w039"}


MORE = [
    (2**63 - 1, "big", "en", "a", 1), (-(2**63), "low", "en", "a", 1), (2**63 - 1, "BIG", "en", "a", 1),
    *[(i * 7**15 % 2**62 - 2**61, f"Text {i}", "en", "é", i) for i in range(300)],
    *[(None, f"N{i % 5}", None, "é", None) for i in range(70)], *[(77, "Same", "en", "hot", 4)] * 300,
    *[(i, f"T{i}", "en", f"s{i:03}", i) for i in range(40)],
]


def test_manifest_equals_sql_on_odd_rows(spark, odd):
    rows = spark.createDataFrame([*ODD_ROWS, *MORE], SCHEMA)
    docs = rows.repartition(4).select("*", *[F.lit("other").alias(c) for c in ("leaf", "place", "total", "word", "n", "slots")])
    assert difference(merkle.manifest(docs), database(rows), sql.MERKLE) is None


def test_manifest_of_few_rows(spark, empty):
    assert merkle.manifest(empty).count() == 0
    one = merkle.manifest(spark.createDataFrame([(5, "Text", "en", "a", 4)], SCHEMA)).first()
    plain = "".join(f"{len(v)}:{v}" for v in ("5", "a", "en", "4", "Text"))
    leaf = hashlib.sha256(plain.encode()).hexdigest()
    assert (one["leaf"], one["subroot"], one["root"]) == (leaf, leaf, leaf)
    assert one["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    changed = hashlib.sha256(plain.replace("Text", "text").encode()).hexdigest() if zlib.crc32(b"5") % 5 == 0 else leaf
    assert (one["folded_root"], one["verified"]) == (changed, changed == leaf)


@pytest.mark.parametrize("fan", [merkle.FAN, 3])
def test_ranks_equal_sorted_places(spark, monkeypatch, fan):
    """A narrow directory has many levels; leaves of one id follow each other by digest."""
    monkeypatch.setattr(merkle, "FAN", fan)
    rng = random.Random(fan)
    ids = [rng.randint(-(2**63), 2**63 - 1) for _ in range(200)] + list(range(-300, 300)) + [5] * 9 + [None] * 30
    rows = [(rng.choice(["a", "b", None]), i, rng.randbytes(32), None) for i in ids]
    df = spark.createDataFrame(rows, "source string, doc_id bigint, leaf binary, tampered binary").withColumn("n", F.lit(1).cast("long"))
    got = {(r["source"], r["doc_id"], bytes(r["leaf"])): (r["place"], r["total"]) for r in merkle.coordinates(df).collect()}
    for source in ("a", "b", None):
        own = sorted(((i is not None, i or 0, i, leaf) for s, i, leaf, _ in rows if s == source))
        assert [got[source, i, leaf] for _, _, i, leaf in own] == [(n, len(own)) for n in range(len(own))]


def test_exact_dedup_equals_sql(spark, odd):
    rows = odd.select("doc_id", "text").where("doc_id NOT IN (4, 6)")
    hot = spark.range(1000, 1400).select(F.col("id").alias("doc_id"), F.concat(F.lit("copy "), F.col("id") % 3).alias("text"))
    docs = rows.unionByName(hot).repartition(5).select("*", F.lit("x").alias("digest"), F.lit("y").alias("row"))
    expected = sql.EXACT_DEDUP.replace("doc_id = max", "doc_id IS NOT DISTINCT FROM max")
    for share in (exact_dedup.SHARE, 4):
        assert difference(exact_dedup.exact_duplicates(docs, share=share), database(docs.select("doc_id", "text")), expected) is None
    left = exact_dedup.remove_copies(docs, share=4)
    assert left.columns == docs.columns
    assert left.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_exact_dedup_of_equal_rows_keeps_one(spark, odd, empty):
    found = exact_dedup.exact_duplicates(odd)
    assert found.count() == odd.count()
    assert found.where("kept").count() == found.select("text_sha256").distinct().count()
    rows = spark.createDataFrame([(7, "a")] * 60 + [(None, "b")] * 40, "doc_id bigint, text string").repartition(4)
    got = exact_dedup.exact_duplicates(rows, share=4).where("kept").select("keep_id", "group_size").collect()
    assert sorted(map(tuple, got), key=str) == [(7, 60), (None, 40)] and exact_dedup.remove_copies(rows, share=4).count() == 2
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.remove_copies(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=40), min_size=1, max_size=5), st.integers(1, 6))
def test_counters_never_miss_a_frequent_digest(batches, most):
    held, counts, seen = np.zeros(0, "V32"), np.zeros(0, np.int64), Counter()
    for batch in batches:
        digests = np.array([bytes([b]) * 32 for b in batch], "V32") if batch else np.zeros(0, "V32")
        held, counts = exact_dedup.count_batch(held, counts, digests, most)
        seen.update(batch)
    found = {k.tobytes()[0]: n for k, n in zip(held, counts.tolist(), strict=True)}
    assert len(found) <= most
    for value, n in seen.items():
        assert n - sum(seen.values()) / (most + 1) <= found.get(value, 0) <= n


def test_frequent_digests_are_few_and_complete(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.unhex(F.sha2(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary"), 256)).alias("digest")
    )
    found = [bytes(r["digest"]) for r in exact_dedup.frequent(df, 16).collect()]
    assert hashlib.sha256(b"hot").digest() in found and len(found) <= 32
    assert pa.array(found).type == pa.binary()
