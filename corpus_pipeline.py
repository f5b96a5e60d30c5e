"""A corpus pipeline over the documents table: five stages, each an operator of lexrev.llm.

Every stage reads what its predecessor wrote. All but the last return the columns of documents, and further columns as they came, whatever
their names. In every stage an empty table gives an empty one; rows whose doc_id is null stay rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexrev.llm.common import bounded_batches
from lexrev.llm.deobfuscate import mask
from lexrev.llm.packing import pack_documents
from lexrev.llm.positions import drop_contaminated
from lexrev.llm.records import default_tokenizer
from lexrev.llm.resample import keep_drawn
from lexrev.llm.simhash import keep_one
from lexrev.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled ones draws.

    Texts that are null, empty or without words go; repeated rows (equal doc_id and text) and rows that tie at the
    threshold stay or go together; texts of any length count whole. Without labels of both kinds the models alone decide.
    """
    bounded_batches(spark)
    return keep_drawn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates.

    Of a group the smallest doc_id stays (a null one only if there is no other), of repeated rows one. Null and empty texts have the fingerprint zero
    and are near-duplicates of each other.
    """
    bounded_batches(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten-word windows of benchmark items.

    Null and empty texts have no words and stay, as all documents do if there are no items; repeated rows stay or go together.
    """
    bounded_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked, and ``n_chars`` counted anew.

    No row goes; null texts stay null, empty ones empty; repeated rows get equal texts; where spans overlap the whole stretch is masked once.
    """
    bounded_batches(spark)
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins of the permitted sequence lengths.

    Null and empty texts are pieces of the end id alone; a text longer than the largest bin is several pieces; repeated rows are
    packed once each; among pieces of one length the smaller doc_id goes first.
    """
    bounded_batches(spark)
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL can express neither the models nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each is written as Parquet and read again."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        table = cut_lineage(stage(spark, table, sf_dir), f"pipeline-{name}")
    return table
