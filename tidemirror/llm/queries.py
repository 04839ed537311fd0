"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemirror.llm import (
    bpe,
    embedding_dedup,
    fill_middle,
    language_id,
    line_dedup,
    merkle,
    minhash_dedup,
    mixing,
    oracles,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    encoded = bpe.encode_documents(documents(spark, sf).select("doc_id", "text"), vocabulary()).drop("text")
    return bpe.decode_documents(encoded, vocabulary()).select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(oracles.RULES)
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements, failed rules and the verdict of the current policy for every document."""
    rows = quality_rules.ledger(documents(spark, sf))
    return rows.select(
        "doc_id",
        *quality_rules.MEASURES,
        "failed",
        (~quality_rules.passes(quality_rules.POLICIES["base"])).alias("base_failed"),
        quality_rules.passes(quality_rules.POLICIES["v1"]).alias("kept"),
    )


@query()
def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every document: counts and places."""
    found = secret_scan.find_secrets(documents(spark, sf))
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(secret_scan.listing(secret_scan.base_spans()).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listing(F.col("spans")).alias("spans"),
    )


@query(oracles.MINHASH)
def op5_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return minhash_dedup.near_duplicates(documents(spark, sf))


@query(oracles.EMBEDDINGS)
def op8_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The links and the near-duplicate class of every embedding."""
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query()
def op3_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix_sources(documents(spark, sf))


@query(oracles.LINES)
def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without later copies of repeated runs of lines."""
    return line_dedup.dedup_lines(documents(spark, sf).select("doc_id", "text"))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@query()
def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query()
def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without later copies of repeated spans of sentences."""
    return substring_dedup.dedup_spans(documents(spark, sf))


@query()
def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Documents sampled towards those labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return quality_classifier.resample(documents(spark, sf), labels.where("quality = 1 AND toxic = 0"))


@query()
def op11_shard(spark: SparkSession, sf: str) -> DataFrame:
    """The shard of every document and its slot there."""
    return sharding.assign(documents(spark, sf).select("doc_id", "text"), keep=["doc_id"])


@query(oracles.FILL_MIDDLE)
def op12_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document cut and put together for fill-in-middle, as digests."""
    made = fill_middle.transform(documents(spark, sf).select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(field: str) -> Column:
    """A field after the tampering: texts lose their capital letters."""
    return F.translate("text", ascii_uppercase, ascii_lowercase) if field == "text" else F.col(field)


@query(oracles.MERKLE)
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its proof still leads a tampered one to the root."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    other = F.when(hit, merkle.leaf([tampered(f) for f in FIELDS]))
    whole = merkle.manifest(documents(spark, sf), fields=FIELDS, carry={"doc_id": F.col("doc_id"), "other": other})
    rows = merkle.proofs(whole, ["doc_id", "other"])
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("other", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
