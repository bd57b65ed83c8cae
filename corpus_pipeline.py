"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; every stage
but the last returns the columns of ``documents``. Null ids pass the filters; rows that share an id
stay or go together; further columns of ``docs`` are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroplan.llm.common import small_side, written
from agroplan.llm.decontaminate import contamination
from agroplan.llm.line_dedup import dedup_lines
from agroplan.llm.ngram_join import ngram_components
from agroplan.llm.packing import pack_documents
from agroplan.llm.quality_ledger import ledger, passes
from agroplan.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(small_side(written(gone.select("doc_id").distinct(), "gone")), "doc_id", "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that policy v2 of the rule ledger rejects."""
    return ledger(docs).where(passes("v2")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of each group of near lines in the corpus; drops documents that have no other words."""
    kept = dedup_lines(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of linked documents, the one with the smallest id."""
    return _without(docs, ngram_components(docs).where("doc_id <> component_id"))


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return _without(docs, contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near_documents", near_documents), ("benchmarks", benchmarks), ("sequences", sequences)]
#: SQL cannot express line components, set similarity by components, and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
