"""One query per operator (``opN_<name>``) over the whole tables, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexrev.llm.common import bounded_batches
from lexrev.llm.deobfuscate import personal_data
from lexrev.llm.edit_sketch import neighbour_fingerprints
from lexrev.llm.oracle import ORACLE_SQL
from lexrev.llm.packing import pack_documents
from lexrev.llm.positions import contamination
from lexrev.llm.quotes import link, quoting_messages
from lexrev.llm.radix_dedup import remove_repeats
from lexrev.llm.records import default_tokenizer, record_digests
from lexrev.llm.resample import resample
from lexrev.llm.revisits import captures, resolve_revisits
from lexrev.llm.simhash import near_duplicates
from lexrev.llm.tile_ranking import rank
from lexrev.llm.turn_repair import damaged, digests, repair
from lexrev.llm.url_trie import judge

__all__ = ["ORACLE_SQL", "QUERIES", "URL_RULES"]

#: Rules of the URL filter query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified revisits of a crawl derived from pages, resolved as of their time; headers sorted, as text."""
    found = resolve_revisits(captures(_table(spark, sf_dir, "pages")))
    entries = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.concat_ws(";", entries))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by Gumbel top-k with importance weights towards the good labelled ones."""
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of every document in bins of four permitted lengths."""
    return pack_documents(_table(spark, sf_dir, "documents"), default_tokenizer())


def op4_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit-distance fingerprints of every document and of its edited text."""
    return neighbour_fingerprints(_table(spark, sf_dir, "documents"))


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark items found in every document by the positional index."""
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"))


def op6_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a 200-byte string found more than once."""
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op7_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt from quoting messages that are derived from the turns."""
    linked = link(quoting_messages(_table(spark, sf_dir, "conversations")))
    return linked.withColumn("own_sha256", F.sha2("own_text", 256)).drop("own_text")


def op8_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, found as it stands and behind disguises."""
    return personal_data(_table(spark, sf_dir, "documents")).drop("base")


def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as framed binary records and read back."""
    return record_digests(_table(spark, sf_dir, "documents"), default_tokenizer())


def op10_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the URL filter on every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(_table(spark, sf_dir, "pages"), rules)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least repairs of damaged conversations; ids, faults, repairs and checksums meet in one grouping, so null ids do too."""
    turns = _table(spark, sf_dir, "conversations")
    summary, messages = repair(damaged(turns))
    rows = turns.select("conv_id").unionByName(summary, True).unionByName(digests(messages), True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_tile_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisit_resolution": op1_revisit_resolution,
    "op2_importance_resampling": op2_importance_resampling,
    "op3_variable_best_fit": op3_variable_best_fit,
    "op4_edit_embedding": op4_edit_embedding,
    "op5_positional_index": op5_positional_index,
    "op6_suffix_radix": op6_suffix_radix,
    "op7_quotation_linking": op7_quotation_linking,
    "op8_deobfuscation": op8_deobfuscation,
    "op9_binary_records": op9_binary_records,
    "op10_simhash_ball": op10_simhash_ball,
    "op11_url_trie": op11_url_trie,
    "op12_turn_repair": op12_turn_repair,
    "op13_tile_ranking": op13_tile_ranking,
}
