"""From raw documents to packed token windows, in five stages.

Every stage takes what its predecessor kept and returns the columns of documents, whatever further ones there are and however they are
called, but for the last, which returns pieces of windows.  ``run`` writes each stage below the session's shared folder and reads it again.

Defined cases: a null text is an empty one; null languages and sources are ``unknown`` in the mix; rows without ``doc_id`` are documents of
their own, except that near copies among them stay; a repeated row is one document from the second stage on; of equal texts
the largest id stays, of near copies the smallest; texts are read whole, however long; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from tradewind.llm.common import stored, table

# Weights of the mix; one epoch, so that what deduplication made unique stays so.
MIX = mixing.Mix(domains=mixing.PRODUCTION.domains, weights=mixing.PRODUCTION.weights, epochs=1, share=(4, 5))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below one half; the model comes from the labelled rows of this stage's input."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def free(docs: DataFrame, *names: str) -> list[str]:
    """Column names that the documents do not have, however many they have."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        found.append(name)
    return found


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id, once; texts without any id are told apart by their digest."""
    digest, kept_id, kept_digest = free(docs, "digest", "kept_id", "kept_digest")
    kept = exact_dedup.exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_digest)).distinct()
    rows = docs.withColumn(digest, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_digest))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", digest]).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies (five-word shingles, 0.8 or more) the document with the smallest id."""
    kept_id, = free(docs, "kept_id")
    kept = near_dedup.near_dedup(docs, words=5, percent=80).where("kept").select(F.col("doc_id").alias(kept_id)).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token budgets of the mix take; a document may be taken once per epoch."""
    taken_id, lang, source, copies, copy = free(docs, "taken_id", "taken_lang", "taken_source", "taken_copies", "copy")
    taken = mixing.mix_sources(docs, MIX).where("copies > 0").select(
        F.col("doc_id").alias(taken_id), F.col("lang").alias(lang), F.col("source").alias(source), F.col("copies").alias(copies)).distinct()
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(mixing.UNKNOWN))
    same = F.col("doc_id").eqNullSafe(F.col(taken_id)) & (named("lang") == F.col(lang)) & (named("source") == F.col(source))
    rows = docs.join(taken, same)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1,024 tokens."""
    return packing.piece_digests(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic), ("exact_dedup", without_copies), ("minhash_near_dedup", without_near_copies),
    ("mixing", mixed), ("packing", packed)]

# Learned scores and tokenizers are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def pipeline_oracles() -> dict[str, str]:
    return {}
