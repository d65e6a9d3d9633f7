"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    chat_format, exact_dedup, language, main_text, mixing, near_dedup, packing, pii, quality, repair, search, secrets, toxicity)
from tradewind.llm.common import table


def is_odd() -> Column:
    """Two deliveries of one table: rows with odd ids came first."""
    return F.coalesce(F.pmod(F.col("doc_id"), F.lit(2)) == 1, F.lit(False))


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.piece_digests(packing.pack(table(spark, folder, "documents")))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace_pii(table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.chat_digests(chat_format.format_chat(turns.unionByName(chat_format.probe(spark))))


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, folder, "documents"), words=2, percent=80)


def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with odd ids are scanned first; the others meet their ledger, so blobs that they share are not scanned again."""
    docs = table(spark, folder, "documents")
    first, ledger = secrets.scan_secrets(docs.where(is_odd()))
    second, _ = secrets.scan_secrets(docs.where(~is_odd()), ledger)
    return secrets.secret_digests(first.unionByName(second))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_language(table(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with odd ids are the indexed history of the others."""
    return exact_dedup.dedup_deliveries(table(spark, folder, "documents"), is_odd())


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_text(table(spark, folder, "pages"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_conversations(table(spark, folder, "conversations"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_packing, op2_pii, op3_chat_formatting, op4_minhash_near_dedup, op5_secret_scans, op6_quality_rules, op7_language_id, op8_exact_dedup, op9_toxicity, op10_mixing,
        op11_lexical_search, op12_html_extraction, op13_conversation_repair)}
