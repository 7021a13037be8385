"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curiomill.llm.bpe import digests
from curiomill.llm.conversations import repair_damaged
from curiomill.llm.covertree import cosine_links
from curiomill.llm.decontaminate import ORACLE as CONTAINED_SQL
from curiomill.llm.decontaminate import contained_items
from curiomill.llm.divergence import ORACLE as DIVERGENCE_SQL
from curiomill.llm.divergence import audit
from curiomill.llm.htmltext import extract_text
from curiomill.llm.langid import identify
from curiomill.llm.minhash import near_duplicates
from curiomill.llm.packing import pack_documents
from curiomill.llm.quality import score_quality
from curiomill.llm.secrets import scan
from curiomill.llm.sharding import shard_by_size
from curiomill.llm.substring import remove_repeated_windows
from curiomill.llm.tables import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents"), texts=False)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_size(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_links(table(spark, sf_dir, "embeddings"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_substring_dedup, op3_decontamination, op4_language_id,
        op5_html_extraction, op6_secret_scan, op7_quality_classifier, op8_sharding,
        op9_embedding_near_dedup, op10_minhash_near_dedup,
        op11_bpe_round_trip, op12_source_divergence, op13_conversation_repair,
    )
}
ORACLES: dict[str, str] = {"op3_decontamination": CONTAINED_SQL, "op12_source_divergence": DIVERGENCE_SQL}
