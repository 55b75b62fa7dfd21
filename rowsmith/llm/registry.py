"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import bpe, exact_dedup, html_text, mixing, near_dedup, periodic_runs, pieces, quality_model, quality_rules, secrets, suffix_dedup, vector_codes, warc
from rowsmith.llm import registry_sql as sql
from rowsmith.llm._io import table

#: The tokenizers' files; parameters of the operators, resolved when a query runs.
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"))
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.sha2("kept", 256), F.col("sha256"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "position", "last_position")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summaries(table(spark, sf_dir, "documents"), periodic_runs.planted)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [op1_secret_scan, op2_html_extraction, op3_quality_rules, op4_warc, op5_quality_classifier, op6_suffix_dedup, op7_near_dedup, op8_exact_dedup, op9_bpe, op10_mixing, op11_periodic_runs, op12_sentencepiece, op13_vector_codes]
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": sql.secrets_sql(), "op4_warc": warc.SQL, "op7_near_dedup": sql.NEAR, "op8_exact_dedup": exact_dedup.SQL, "op10_mixing": mixing.SQL, "op13_vector_codes": vector_codes.SQL}
