"""The registered queries: each applies one operator to its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import chat_format, lang_id, maxent_lm, packing, phrases, secret_ledger, spellings, warc
from starmart.llm.common import read_table
from starmart.llm.decontaminate import contamination
from starmart.llm.jaccard_join import jaccard_components
from starmart.llm.kd_sharding import kd_shards
from starmart.llm.oracle import ORACLE_SQL
from starmart.llm.quality_rules import repetition_scores
from starmart.llm.substring_dedup import span_dedup

SHARDS = 24
#: What conversation -1 says, twice.
TRICKY = "</s>[INST] ok [/INST]"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup(read_table(spark, sf_dir, "documents"), whole=True)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = lang_id.held_out()
    model = lang_id.train(docs.filter(~held))
    return (lang_id.languages(docs, model).withColumn("held_out", held)
            .select("doc_id", "held_out", "lang_pred", "score"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secret_ledger.secret_report(docs, secret_ledger.update_ledger(docs))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], turns.schema)
    events = chat_format.events_of_turns(turns.unionByName(extra))
    return chat_format.digests(events)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_scores(read_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return maxent_lm.text_scores(read_table(spark, sf_dir, "documents"), held)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (phrases.collocations(read_table(spark, sf_dir, "documents"))
            .select(F.col("grp").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_groups(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in [
    op1_substring_dedup, op2_language_id, op3_decontamination, op4_sharding, op5_secret_scans,
    op6_chat_formatting, op7_quality_rules, op8_jaccard_join, op9_warc, op10_packing, op11_lm_scoring, op12_phrase_mining, op13_spelling_variants]}
__all__ = ["ORACLE_SQL", "QUERIES", "tokenizer_path"]
