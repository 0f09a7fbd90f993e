"""One query per operator over its whole table, with production parameters, and SQL where it can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.llm import byte_bpe, exact_dedup, exact_topk, language_id, licenses, merkle, ngram_join, packing, pii, quality_gam
from pasarlens.llm import quality_rules, spelling, sql, substring_dedup

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return quality_gam.score_quality(documents, quality_gam.fit_quality(documents, _table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode_documents(
        _table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken", decode=True
    )
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[of(kind) for kind in pii.BASE_KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_topk(_table(spark, sf_dir, "embeddings"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return language_id.label_languages(documents, language_id.fit_languages(documents))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_packing": op2_packing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_ngram_join": op4_ngram_join,
    "op5_pii": op5_pii,
    "op6_exact_topk": op6_exact_topk,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_id": op8_language_id,
    "op9_licenses": op9_licenses,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling": op11_spelling,
    "op12_merkle": op12_merkle,
    "op13_exact_dedup": op13_exact_dedup,
}

_WORDS = r"[^\x20\x09-\x0D]+"
_STOP_SQL = ", ".join("'" + w + "'" for w in quality_rules.STOP_FORMS)

ORACLE: dict[str, str] = {
    "op11_spelling": sql.SPELLING,
    "op12_merkle": sql.MERKLE,
    "op13_exact_dedup": sql.EXACT_DEDUP,
    "op7_substring_dedup": rf"""
        WITH w AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents),
        win AS (
            SELECT r, doc_id, i, array_to_string(ws[i : i + 12], ' ') AS g
            FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
        f AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
        gone AS (
            SELECT DISTINCT r, p
            FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM win JOIN f USING (g) WHERE first < doc_id)),
        every AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w WHERE len(ws) > 0),
        kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY p) AS t
            FROM every ANTI JOIN gone USING (r, p) GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words,
            (SELECT count(*) FROM gone WHERE gone.r = w.r)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (r)""",
    "op4_ngram_join": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
            FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (
            SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 10 * k >= 8 * (x.n + y.n - k)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(node, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
        SELECT node AS doc_id, min(root) AS class_id,
            (SELECT count(*) FROM e WHERE e.a = node)::BIGINT AS n_links
        FROM r GROUP BY node""",
    "op6_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM pairs)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op10_quality_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (
            SELECT *, regexp_extract_all(t, '{_WORDS}') AS ws,
                list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORDS}')) AS ls
            FROM d),
        triples AS (
            SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
        again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM triples) WHERE n > 1),
        covered AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
        m AS (
            SELECT doc_id, len(ws)::BIGINT AS n_words,
                length(array_to_string(ws, ''))::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                coalesce(n, 0)::BIGINT AS n_repeat_words,
                len(ls)::BIGINT AS n_lines,
                len(list_filter(ws, lambda x: x IN ({_STOP_SQL})))::BIGINT AS n_stop_words
            FROM w LEFT JOIN covered USING (r)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed
                AND word_chars / n_words BETWEEN 2.0 AND 15.0
                AND n_symbols / n_words <= 0.1
                AND n_stop_words / n_words >= 0.02
                AND n_dup_lines / n_lines <= 0.5 AS kept,
            n_lines, n_stop_words
        FROM b""",
}
