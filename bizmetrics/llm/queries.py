"""The operators as queries over the test tables: whole tables, production parameters, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bizmetrics.llm.conversation_repair import conversation_audit
from bizmetrics.llm.decontamination import document_contamination
from bizmetrics.llm.license_scan import document_licenses
from bizmetrics.llm.near_duplicates import document_groups
from bizmetrics.llm.quality_rules import document_quality
from bizmetrics.llm.secret_scan import document_secrets
from bizmetrics.llm.sentence_pieces import document_samples
from bizmetrics.llm.sharding import document_shards
from bizmetrics.llm.simhash_groups import document_simhash
from bizmetrics.llm.source_divergence import source_audit
from bizmetrics.llm.token_blocks import document_tokens
from bizmetrics.llm.toxicity import document_toxicity
from bizmetrics.llm.warc import page_records


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _over(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(_read(spark, sf_dir, table) for table in tables))

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_blocks": _over(document_tokens, "documents"),
    "op2_benchmark_decontamination": _over(document_contamination, "documents", "benchmark"),
    "op3_sharding": _over(document_shards, "documents"),
    "op4_sentencepiece": _over(document_samples, "documents"),
    "op5_quality_rules": _over(document_quality, "documents"),
    "op6_secret_scans": _over(document_secrets, "documents"),
    "op7_warc": _over(page_records, "pages"),
    "op8_toxicity": _over(document_toxicity, "documents", "labels"),
    "op9_minhash_near_dedup": _over(document_groups, "documents"),
    "op10_license_scans": _over(document_licenses, "documents"),
    "op11_conversation_repair": _over(conversation_audit, "conversations"),
    "op12_simhash_near_dedup": _over(document_simhash, "documents"),
    "op13_source_divergence": _over(source_audit, "documents"),
}
