"""Corpus pipeline: from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of documents; ``run`` writes each
stage's result to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontamination, language_id, packing, pii, simhash_dedup
from tripmart.llm.common import row_digest, stored

#: Bytes of pre-tokens kept in a Python worker: the stages share the executors, and
#: what one leaves in an idle worker is missing to the next.
CACHE_BYTES = 48 << 20
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _spare(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language: a null text, or one without a letter.

    The others keep all their columns; lang becomes the predicted language
    where it was null. The classifier is fitted on the labelled documents of
    the input itself. Repeated rows stay; an empty table stays empty.
    """
    name = _spare(docs)
    found = language_id.identify(docs, language_id.train(docs), name, f"{name}score").where(F.col(name) != language_id.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", name)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component: the smallest doc_id.

    Ids come before nulls; of rows that share that id the one with the
    smallest row digest stays, and of rows equal in id and text one. Null and
    empty texts are one component. An empty table stays empty.
    """
    name = _spare(docs)
    groups = simhash_dedup.near_duplicates(docs, shingle=3, radius=3)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = groups.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.key").alias(name))
    kept = docs.withColumn(name, row_digest()).join(first, name, "left_semi")
    return kept.dropDuplicates([name]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item.

    Null, empty and wordless texts hold none and stay, as do repeated rows
    of clean documents. An empty table stays empty.
    """
    name = _spare(docs)
    hits = decontamination.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = hits.select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, row_digest()).join(gone, name, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in text by its kind; n_chars follows (null for a null text)."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096-token sequences, as in op6_packing.

    A null or empty text is one end token; repeated rows are packed each; an
    empty table gives no pieces.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096,
                        cache_bytes=CACHE_BYTES)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Fitted models, SimHash components and tokenizers have no plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
