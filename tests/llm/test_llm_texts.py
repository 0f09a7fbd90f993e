"""Operators that look at one text at a time, against plain versions."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_llm import SF_DIR, pairs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pasarlens.llm import byte_bpe, licenses, packing, pii, quality_rules
from pasarlens.llm.text_arrays import pieces

MULTI = "byte_bpe_multi_50k.tiktoken"
ALPHABET = st.sampled_from(list("ab cd\n\t'.,!s1éß×÷— 　日\x1c\x85'") + ["the ", " don't", "'s", "  ", "\r\n"])


@pytest.fixture(scope="module")
def tiktoken_encoding():
    with open(public_tokenizers.path(MULTI), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return own


def ids_of(name, texts):
    import pyarrow as pa

    out = []
    for _, _, data, offsets in pieces(pa.array(texts, pa.string())):
        ids, at = byte_bpe.encoder(name).encode(data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_bpe_equals_both_libraries(tiktoken_encoding, tokenizer, text):
    assert ids_of(MULTI, [text]) == [tiktoken_encoding.encode_ordinary(text)]
    assert ids_of("byte_bpe_50k.json", [text]) == [tokenizer.encode(text, add_special_tokens=False).ids]


@pytest.fixture(scope="module")
def default_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


MARK = "<|endoftext|>"
MARKED = st.lists(st.sampled_from([MARK, MARK[:7], MARK[7:], " ", "  ", "\n", "a", " the", "'t", "1", "é", "<|"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(MARKED, min_size=1, max_size=6))
def test_bpe_knows_the_added_tokens_of_the_file(default_tokenizer, texts):
    texts = ["a <|endoftext|> b", *texts, MARK[:7], MARK[7:]]
    expected = [default_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0] == [64, 220, 50256, 275]
    assert ids_of("byte_bpe_50k.json", texts) == expected
    vocabulary = byte_bpe.encoder("byte_bpe_50k.json").vocabulary
    assert [vocabulary.decode(np.array(ids, np.int64)).tobytes().decode() for ids in expected] == texts


def test_packing_of_a_text_with_an_added_token(spark, default_tokenizer):
    text = "one text <|endoftext|>\n\nand another<|endoftext|>"
    row = packing.pack_documents(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    ids = [*default_tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_bpe_round_trip_of_given_and_odd_texts(documents, odd, tiktoken_encoding):
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    coded = byte_bpe.encode_documents(both.withColumn("n", F.lit(1)), MULTI, decode=True).collect()
    texts = {}
    for r in both.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    assert len(coded) == sum(map(len, texts.values()))
    for r in coded:
        text = bytes(r["decoded"]).decode()
        assert text in texts[r["doc_id"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == tiktoken_encoding.encode_ordinary(text)


def test_bpe_of_a_word_longer_than_any_row(tiktoken_encoding):
    text = "ab" * 4000 + "z" * 3000
    assert ids_of(MULTI, [text]) == [tiktoken_encoding.encode_ordinary(text)]


def base_spans(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    def found(pattern, ok):
        return [m.span() for m in re.finditer(pattern, text) if ok(m.group())]

    return {
        "email": found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": found(r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": found(r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }


PII_PARTS = st.sampled_from(
    ["a", "@", "b.c", ".", "_", "%", "1", "255", "256", "0", "4111 1111 1111 1111", "+", "+49 (30) 1234-567", "-", " ", "é", "12"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PII_PARTS, max_size=25).map("".join))
def test_base_spans_equal_the_plain_expressions(text):
    spans = pii.spans_of(text)
    for kind, expected in base_spans(text).items():
        assert [(s, e) for k, s, e, _ in spans if k == kind] == expected


def test_more_spans_need_a_checksum_or_context():
    kinds = {k for k, *_ in pii.spans_of("IBAN DE89 3704 0044 0532 0130 00, DE00 3704 0044 0532 0130 00")}
    assert "iban" in kinds
    assert not [1 for k, *_ in pii.spans_of("DE00 3704 0044 0532 0130 00") if k == "iban"]
    assert pii.spans_of("0123456789abcdef0123456789abcdef") == []
    assert [k for k, *_ in pii.spans_of('token = "0123456789abcdef0123456789abcdef"')] == ["secret"]


def test_iban_ends_before_what_follows():
    german, british = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    norwegian, unlisted = "NO93 8601 1117 947", "ZZ" + next(f"{n:02}" for n in range(98) if pii.mod97(f"ZZ{n:02}12345678901234"))
    unlisted += " 1234 5678 9012 34"
    for iban in (german, british, norwegian, unlisted, german.replace(" ", "")):
        for after in ("", " BIC COBADEFF", " 2024", " TOTAL DUE NOW AND IN CAPITALS", " and words", ", end"):
            found = [(s, e) for k, s, e, _ in pii.spans_of(f"pay {iban}{after}") if k == "iban"]
            assert found == [(4, 4 + len(iban))], (iban, after)
            assert pii.redacted(f"pay {iban}{after}") == f"pay [IBAN]{after}"
    assert pii.redacted(f"{german} {british} {norwegian}") == "[IBAN] [IBAN] [IBAN]"
    assert pii.redacted(f"REF AB12 {german}") == "REF AB12 [IBAN]"


def test_pii_over_odd_rows(odd, empty, documents):
    assert pii.find_pii(odd).count() == odd.count()
    assert pii.find_pii(empty).count() == 0
    redacted = pii.redact_pii(odd)
    assert redacted.schema == odd.schema
    assert redacted.where("text IS NULL").count() == odd.where("text IS NULL").count()
    again = pii.find_pii(pii.redact_pii(documents))
    assert again.where(F.exists("spans", lambda s: s["kind"].isin("email", "ip"))).count() == 0


def license_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def test_licenses_equal_a_plain_scan(spark, documents, odd):
    notice = "MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    own = spark.createDataFrame(
        [(901, notice + "associated documentation files"), (902, "CC BY, cc-by; GENERAL public LICENSE"), (903, notice)],
        "doc_id bigint, text string",
    )
    rows = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(own)
    got = licenses.scan_licenses(rows).collect()
    assert len(got) == rows.count()
    expected = {}
    for r in rows.collect():
        words = license_words(r["text"] or "")
        places, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            part = phrase.split()
            hits = [i for i in range(len(words)) if words[i : i + len(part)] == part]
            places += hits
            labels |= {label} if hits else set()
        bounds = (min(places), max(places)) if places else (None, None)
        expected.setdefault(r["doc_id"], []).append((len(words), len(places), *bounds, sorted(labels)))
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) in expected[r["doc_id"]]
        assert set(r["base_labels"]) <= set(r["labels"])
        assert 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[901] == ["mit"] and labels[902] == ["cc-by", "gpl"] and labels[903] == []


def plain_licenses(text):
    """Labels and best share by trying every template at every place of the text."""
    index = licenses.template_index()
    words, labels, best = license_words(text), set(), 0.0
    for (label, wanted, keys), rare in zip(licenses.TEMPLATES, index.rare, strict=True):
        wanted = wanted.split()
        for begin in range(-len(wanted) + 1, len(words)):
            same = [0 <= begin + i < len(words) and words[begin + i] == w for i, w in enumerate(wanted)]
            if sum(same[i] for i in rare) < max(1, math.ceil(licenses.AGREE * len(rare))):
                continue
            places = [(licenses._find(wanted, key.split()), len(key.split())) for key in keys]
            if all(all(same[a : a + n]) for a, n in places):
                labels.add(label)
                best = max(best, sum(same) / len(wanted))
    return labels, best


def test_labels_equal_a_plain_alignment(spark):
    rng, texts = random.Random(9), []
    for _, wanted, _ in licenses.TEMPLATES:
        words = wanted.split()
        texts.append("Copyright 2001, " + wanted.upper() + ".")
        changed = [rng.choice(["the", "x9", w]) if rng.random() < 0.3 else w for w in words]
        texts += [" ".join(words[: len(words) // 2]), " ".join(words[3:]) + " " + " ".join(changed)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(rows).collect()}
    for i, text in enumerate(texts):
        labels, best = plain_licenses(text)
        assert set(got[i]["labels"]) == labels | set(got[i]["base_labels"])
        assert got[i]["score"] == pytest.approx(1.0 if got[i]["base_labels"] else best)
    for i, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert label in got[3 * i]["labels"]


def test_no_label_in_ordinary_documents(documents):
    scanned = licenses.scan_licenses(documents.select("doc_id", "text"))
    more = scanned.where("size(labels) > size(base_labels)").count()
    assert more <= documents.count() // 100


def test_quality_rules_on_odd_rows(odd, empty):
    assert quality_rules.quality_rules(empty).count() == 0
    got = quality_rules.quality_rules(odd)
    assert "PythonUDF" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == odd.count()
    for r in got.where("doc_id IN (1, 2, 3)").collect():
        assert (r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (0, 0, True, False)


def repeated_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)})


def test_repeated_words_equal_a_plain_count(spark):
    texts = ["a b c a b c", "a a a a", "a b", "x y z", "a b c d a b c e a b c", "a b\na b\na b", "é é é é x é é é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.quality_rules(rows).collect()}
    assert got == {i: repeated_words(t) for i, t in enumerate(texts)}


def test_packing_places_every_piece_once(spark, documents, odd, tokenizer):
    rows = documents.select("doc_id", "text").unionByName(odd.where("doc_id IN (1, 2, 7)").select("doc_id", "text").withColumn(
        "doc_id", F.col("doc_id") + 100_000))
    got = pairs(packing.pack_documents(rows).collect(), "doc_id")
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    assert set(got) == set(texts)
    places, total = {}, 0
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        total += len(ids)
        at = 0
        for i, r in enumerate(sorted(got[doc], key=lambda r: r["piece"])):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (i, at, zlib.crc32(part))
            assert i == 0 or r["length"] == 1024
            at += r["length"]
            places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == len(ids)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(places) <= 1.02 * total / 1024 + 1


def test_packing_of_nothing_repeats_and_sequences(spark, empty, odd):
    assert packing.pack_documents(empty).count() == 0
    packed = packing.pack_documents(odd, with_ids=True)
    assert packed.where("piece = 0").count() == odd.count()
    joined = packing.sequences(packed)
    assert joined.where("n_tokens > 1024 OR octet_length(ids) <> 4 * n_tokens").count() == 0
    assert joined.agg(F.sum("n_tokens")).first()[0] == packed.agg(F.sum("length")).first()[0]


def held_pieces(whole, capacity):
    held = {}
    for contents, n in whole.items():
        assert sum(contents) <= capacity and n > 0
        for length in contents:
            held[length] = held.get(length, 0) + n
    return held


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_packing_holds_every_piece_in_no_more_sequences_than_best_fit(counts):
    whole, least = packing.pack_counts(counts, 64)
    assert held_pieces(whole, 64) == counts
    plain = packing.round_configurations({}, counts, 64)
    assert held_pieces(plain, 64) == counts
    assert least <= sum(whole.values()) <= sum(plain.values())
    assert held_pieces(packing.round_configurations(packing.solve_configurations(counts, 64)[0], counts, 64), 64) == counts


@pytest.mark.parametrize("low, high, gap", [(1, 1023, 0.005), (200, 520, 0.02), (330, 700, 0.015)])
def test_packing_comes_near_the_bound(low, high, gap):
    lengths, times = np.unique(np.random.default_rng(0).integers(low, high + 1, 20_000), return_counts=True)
    whole, least = packing.pack_counts(dict(zip(lengths.tolist(), times.tolist(), strict=True)), 1024)
    assert least <= sum(whole.values()) <= (1 + gap) * least


def test_packing_of_document_lengths_comes_near_the_bound(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/documents.parquet")
    pieces = packing.tokenized_pieces(docs).groupBy("length").count().collect()
    whole, least = packing.pack_counts({r["length"]: r["count"] for r in pieces}, 1024)
    assert least <= sum(whole.values()) <= 1.001 * least


@pytest.mark.parametrize("name", [MULTI, "byte_bpe_50k.json"])
def test_pieces_that_hash_alike_are_encoded_apart(monkeypatch, name):
    """Long words that a weaker hash confused, and a hash that confuses everything of one length."""
    morse = ["".join((a, b)[bin(i).count("1") & 1] for i in range(1024)) for a, b in ("ab", "ba")]
    texts = [*morse, "cat and dog", "dog and cat", "", "tea at ten <|endoftext|> 12 34"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    own = byte_bpe.Encoder(byte_bpe.encoder(name).vocabulary, public_tokenizers.PATTERN)
    ids, places = own.encode(data, offsets)
    assert own.vocabulary.decode(ids).tobytes() == data.tobytes()
    weak = byte_bpe.Encoder(own.vocabulary, public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe, "hash_ranges", lambda data, starts, ends: (ends - starts).astype(np.uint64) + np.uint64(1))
    got, bounds = weak.encode(data, offsets)
    assert got.tolist() == ids.tolist() and bounds.tolist() == places.tolist()


def test_digest_of_ids_is_little_endian(documents):
    row = byte_bpe.encode_documents(documents.limit(1), MULTI).select("ids", F.sha2("ids", 256).alias("h")).first()
    assert hashlib.sha256(bytes(row["ids"])).hexdigest() == row["h"]


def test_coding_and_scanning_of_empty_tables(empty):
    assert byte_bpe.encode_documents(empty, MULTI, decode=True).count() == 0
    assert licenses.scan_licenses(empty).count() == 0
