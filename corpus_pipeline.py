"""From raw documents to packed sequences. Each stage works on all rows that the one before it kept.

All stages but the last return the columns of their input; ``n_chars`` follows a changed text. Rows with a null id pass the
stages on pairs unchanged; further results in special cases are those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pasarlens.llm import language_id, ngram_join, packing, pii, substring_dedup
from pasarlens.llm.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, null texts and texts of no clear language go: those whose best language is less probable than nearly
    all held-out labelled texts have it."""
    net = language_id.fit_languages(docs)
    return language_id.keep_known(docs, net, language_id.score_limit(docs, net))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row of the smallest id stays (one of them, if several rows share it and the text). Each
    row is judged by its own text: rows that share an id all stay if their texts are not linked."""
    first = ngram_join.first_texts(docs)
    rows = docs.where("doc_id IS NOT NULL").select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    # equal rows become one before they are dealt out, so that no task gets all rows of an id; of rows that differ in other
    # columns the smallest by a hash of them stays
    equal = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("row"))
    once = rows.withColumn("nth", F.row_number().over(equal)).where("nth = 1")
    kept = once.join(first, ["doc_id", "text_hash"], "left_semi").select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in long spans that stand in a document of smaller id are cut out."""
    left = substring_dedup.remove_repeats(docs, carry=True)
    return _counted(left.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns]))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _counted(pii.redact_pii(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_languages),
    ("ngram_join", one_of_each),
    ("substring_dedup", without_repeats),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: No SQL: the language network, the tokenizer and the packing cannot be written in it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
