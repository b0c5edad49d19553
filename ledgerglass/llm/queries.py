"""The numbered queries: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from ledgerglass.llm import (
    collocations,
    conversation_packing,
    decontamination,
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    maxent_lm,
    packing,
    quality_rules,
    secret_scan,
    sharding,
    spelling_variants,
    token_files,
)
from ledgerglass.llm.oracle import ORACLE as ORACLE
from ledgerglass.llm.shared import shared_uri
from ledgerglass.sources.stage import stage


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards: 4 regions of 5 racks of 2."""
    return sharding.assign_shards(_documents(spark, sf_dir), sharding.even_tree(4, 5, 2))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = shared_uri(spark, "tokens")
    manifest = token_files.write_token_files(_documents(spark, sf_dir), uri, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return token_files.read_token_files(manifest, uri)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(_documents(spark, sf_dir)).drop("row")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on web pages, whose addresses have suffixes and domains."""
    return language_id.identify_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("row").withColumnRenamed("doc_id", "page_id")


def op5_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_texts(_documents(spark, sf_dir), maxent_lm.fold())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end=1)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss")


def packing_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same heuristic where all three limits bind: conversations, with loss on the assistant's turns only."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_packing.pack_conversations(turns, public_tokenizers.path("word_bpe_49k.json"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secret_scan.findings(docs, stage(secret_scan.scan(docs)))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_passages(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_documents(spark, sf_dir)).drop("copy")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.filter_quality(_documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.word_counts(_documents(spark, sf_dir), noise=spelling_variants.NOISE))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_sharding,
        op3_token_files,
        op4_language_id,
        language_id_pages,
        op5_maxent_lm,
        op6_exact_dedup,
        op7_packing,
        packing_conversations,
        op8_secret_scan,
        op9_decontamination,
        op10_jaccard_join,
        op11_quality_rules,
        op12_spelling_variants,
        op13_collocations,
        pipeline,
    )
}
