"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import contamination, proximity_matches
from .lexical_search import SEARCH_SQL, search
from .license_scan import scan, train
from .line_dedup import dedup_lines
from .ngram_join import ngram_components
from .packing import pack_documents
from .quality_ledger import ABLATION_SQL, BASE, LEDGER_SQL, ablations, passes, stored_ledger
from .suffix_dedup import repeated_spans
from .token_binary import read_token_files, write_token_files
from .toxicity import fit, held_out, score_documents
from .url_filter import URL_SQL, judge_urls
from .vector_codes import CODES_SQL, codebook_digest, encode_vectors, with_label_errors
from .warc import capture_runs, merge_runs, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = scan(docs, train(docs))
    return found.select("doc_id", "n_paragraphs", "n_predicted", "n_confirmed", F.array_join("families", ",").alias("families"), F.round("score", 3).alias("score"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(_table(spark, sf_dir, "pages"))
    index = merge_runs(capture_runs(archives))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "rank")


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, table = write_token_files(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return read_token_files(spark, blocks, table)


def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("failed").bitwiseAND(F.lit(BASE).cast("long")) != 0
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    stored = stored_ledger(_table(spark, sf_dir, "documents"))
    return stored.select(*columns, base.alias("base_failed"), "failed", passes("v1").alias("kept_v1"), passes("v2").alias("kept"))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ablations(stored_ledger(_table(spark, sf_dir, "documents")), "v2")


def proximity_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proximity_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("begin").cast("long").alias("begin"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("items")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("hits").alias("n_hits"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = encode_vectors(_table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(book)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_warc_index": op2_warc_index,
        "op3_token_binary": op3_token_binary,
        "op4_quality_ledger": op4_quality_ledger,
        "op5_url_rules": op5_url_rules,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
        "op8_decontamination": op8_decontamination,
        "op9_packing": op9_packing,
        "op10_line_dedup": op10_line_dedup,
        "op11_lexical_search": op11_lexical_search,
        "op12_toxicity": op12_toxicity,
        "op13_vector_codes": op13_vector_codes,
        "quality_ablations": quality_ablations,
        "proximity_search": proximity_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_ledger": LEDGER_SQL, "quality_ablations": ABLATION_SQL, "op5_url_rules": URL_SQL, "op11_lexical_search": SEARCH_SQL, "op13_vector_codes": CODES_SQL}
