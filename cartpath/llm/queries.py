"""The registered queries of this package: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cartpath.llm import (
    ann,
    decontaminate,
    line_dedup,
    near_dup,
    ngram_rules,
    packing,
    prefix_trie,
    quality,
    sharding,
    spelling,
    suffix_dedup,
    url_filter,
    warc,
)
from cartpath.llm.common import Query, read_table, work_path, written

SHARDS = sharding.grid(2, 3, 4)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", "doc_id", "text")


def sha256(text: str = "text"):
    return F.sha2(F.col(text).cast("binary"), 256)


def suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_dedup.dedup_substrings(documents(spark, folder))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256().alias("kept_sha256"))


def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages", "page_id", "url")
    judged = url_filter.filter_captures(url_filter.dated_captures(pages), url_filter.derived_changes(pages))
    day = F.date_format("fetched_on", "yyyy-MM-dd").alias("fetched_on")
    return judged.select("page_id", "url", "host", day, "blocked", "list_name", "n_entries")


def quality_model(spark: SparkSession, folder: str, docs: DataFrame) -> quality.RuleModel:
    """Learned from the labels of the folder, but for those of held-out documents."""
    labels = read_table(spark, folder, "labels", "doc_id", F.col("quality").alias("label"))
    return quality.fit(docs, labels.where(~quality.held_out()))


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    scored = quality.score(docs, quality_model(spark, folder, docs))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256().alias("kept_sha256"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, folder), read_table(spark, folder, "benchmark", "item_id", "text"))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text").cast("binary")
    sized = documents(spark, folder).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard(sized, "doc_id", SHARDS, sharding.grown(SHARDS, 24))


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(read_table(spark, folder, "embeddings", "vec_id", "embedding"))


def archives(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "warc")
    warc.write_archives(warc.records(read_table(spark, folder, "pages", "page_id", "url", "html")), path)
    read = written(warc.without_payload(warc.read_records(spark, path)), "warc-records")
    return warc.page_captures(warc.captures(read))


def sequences(docs: DataFrame) -> DataFrame:
    return packing.pack(packing.pieces(docs, tokenizer_path()))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, folder))


def spellings(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder))


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are labelled good are the trusted ones, but for those held out from learning."""
    labels = read_table(spark, folder, "labels", "doc_id", "quality")
    trusted = labels.where("quality = 1").where(~quality.held_out()).select("doc_id")
    judged = ngram_rules.apply_rules(documents(spark, folder), trusted, with_text=False)
    return judged.select("doc_id", *ngram_rules.STATISTICS, "base_failed", "kept", "score")


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_array_dedup": suffix_array,
        "op2_url_filters": url_filters,
        "op3_quality_classifier": quality_classifier,
        "op4_line_dedup": lines,
        "op5_benchmark_decontamination": decontamination,
        "op6_sharding": shards,
        "op7_nearest_neighbours": nearest,
        "op8_warc": archives,
        "op9_best_fit_packing": lambda spark, folder: sequences(documents(spark, folder)),
        "op10_minhash_near_dedup": near_duplicates,
        "op11_spelling_variants": spellings,
        "op12_conversation_prefix_trie": conversation_trie,
        "op13_quality_rules": quality_rules,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    from cartpath.llm import oracle

    return oracle.oracle_sql()
