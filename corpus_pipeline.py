"""From raw documents to token ids, a stage at a time.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All
but the last return the columns of documents, with ``n_chars`` as the length of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemirror.llm import bpe, language_id, line_dedup, minhash_dedup, mixing
from tidemirror.llm.queries import held_out, vocabulary
from tidemirror.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A language that is less likely than this is not accepted.
SURE = 0.5
# A repeated run of lines goes if it has so many words, a single line also if it occurs more often than that.
LINE_WORDS = 4
LINE_COPIES = 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; the others carry the predicted one."""
    model = language_id.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = language_id.predict(docs, model)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= SURE)).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go, and documents of which nothing but blank lines is left."""
    cleaned = line_dedup.dedup_lines(docs, min_words=LINE_WORDS, max_copies=LINE_COPIES)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(line_dedup.NOT_BLANK)
    return cleaned.where(left).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, and of rows that repeat id and text; rows without an id stay."""
    classes = minhash_dedup.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    with_id = docs.where("doc_id IS NOT NULL").join(classes, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return with_id.unionByName(docs.where("doc_id IS NULL")).select(*COLUMNS)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; rows that repeat every column are taken equally often."""
    keyed = docs.withColumn("_key", F.xxhash64(*COLUMNS))
    copies = mixing.mix_sources(keyed, doc_id="_key").groupBy(F.col("doc_id").alias("_key")).agg(F.max("copies").alias("_copies"))
    taken = keyed.join(copies.where("_copies > 0"), "_key")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with their number."""
    return bpe.encode_documents(docs.select("doc_id", "source", "lang", "text"), vocabulary()).select(
        "doc_id", "source", "lang", bpe.n_tokens().alias("n_tokens"), "token_ids"
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("minhash_dedup", keep_one_of_each),
    ("mix_sources", mix_to_weights),
    ("bpe_encode", encode),
]

# Regression, components and Newton steps have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
