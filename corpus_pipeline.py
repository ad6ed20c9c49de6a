"""The corpus pipeline: each stage takes the documents that the one before kept.

Stages are (name, function of (spark, docs, sf_dir)); all but the last return the columns
of `documents`. run() writes each stage's result to the shared folder and reads it again,
so that a lost executor never costs more than a stage.

Cases, which follow from the operators: null and empty texts aren't toxic, have no near
duplicates and no secrets, and are never taken by the mix, as they have no words; very
long texts are read whole by every stage; rows without an id are no one's near
duplicate; rows that repeat with words in them are one after the second stage; of equal
sets the smallest id stays; a score that equals the threshold is rejected; an empty table
gives an empty result; other columns of the documents pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skjald.llm import bpe, minhash, mixing, secrets, toxicity
from skjald.llm.common import cut, remove, shared_path, table, with_free_names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity score is at least the threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return minhash.without_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by marks."""
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, which may be never."""
    return with_free_names(docs, _mixed)


def _mixed(docs: DataFrame) -> DataFrame:
    mix = cut(mixing.mix_documents(docs).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("copies").alias("__copies")))
    # Rows that repeat in id, source and size share their copies: the n-th row gets those of rank n.
    key = [F.col("doc_id").eqNullSafe(F.col("__id")), F.col("source").eqNullSafe(F.col("__source")), F.col("__n") == F.col("__size")]
    rows = docs.withColumn("__n", mixing.word_count("text"))
    once = mix.groupBy("__id", "__source", "__size").agg(F.count("*").alias("__rows"), F.sum("__copies").alias("__copies"))
    many = once.filter("__rows > 1")
    taken = mixing.repeated(rows.join(once.filter("__rows = 1"), key[0] & key[1] & key[2]), F.col("__copies")).select(*docs.columns)
    if many.isEmpty():
        return taken
    return taken.unionByName(mixing.repeated(mixing.ranked(rows.join(many, key[0] & key[1] & key[2]), ["__id", "__source", "__size"]), F.expr("__copies div __rows + cast(__rank <= __copies % __rows as int)")).select(*docs.columns))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, token ids and their number of each document."""
    return bpe.encode_documents(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("source mix", mix_sources),
    ("byte-level bpe", encode_tokens),
]
#: The classifier, the signatures and the tokenizer aren't SQL: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        at = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(at)
        if before:  # nothing reads it any more
            remove(spark, before)
        docs, before = spark.read.parquet(at), at
    return docs
