"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from surveyloom.llm import (
    decontaminate,
    filter_audit,
    html_extract,
    langid,
    mixing,
    quality,
    secrets,
    sketch,
    spelling,
    token_files,
    toxicity,
    warc,
)
from surveyloom.llm.neardup import near_duplicates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by two co-trained views."""
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text."""
    return sketch.edit_report(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of benchmark windows."""
    return decontaminate.report(decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over sets of two-word shingles."""
    return near_duplicates(_table(spark, sf_dir, "documents"), size=2, percent=80)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    return warc.round_trip(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by segmentation-marginalised unigrams."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a mix at 150 % of all words takes each document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document after deobfuscation."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document by pattern and entropy."""
    return secrets.report(secrets.scan(_table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of all documents with each word's form."""
    return spelling.document_variants(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language's documents, in every order."""
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token ids and read back."""
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality": op4_quality,
    "op5_fingerprints": op5_fingerprints,
    "op6_decontamination": op6_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scan": op10_secret_scan,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_files": op13_token_files,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL for the same rows, where SQL can express them on whole tables.
ORACLE: dict[str, str] = {
    "op1_warc": warc.WARC_SQL,
    "op3_mix_sources": mixing.MIX_SQL,
    "op12_filter_audit": filter_audit.AUDIT_SQL,
}
