"""From documents to packed training sequences: five stages, each written and read again by the next.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.llm import decontaminate, line_dedup, near_dup
from cartpath.llm.common import read_table, release, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, learned on the labels and the given documents, rejects."""
    from cartpath.llm import quality
    from cartpath.llm.queries import quality_model

    scored = quality.score(docs, quality_model(spark, sf_dir, docs.select("doc_id", "text")))
    # Written before it is looked at: a filter on the verdict would be put in terms of the text, and every rule
    # would count its statistics anew.
    scored = written(scored.select(*COLUMNS, "predicted"), "scored")
    return scored.where("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that recur across documents; every document stays, with its remaining text and its length."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest doc_id stays; rows without an id all stay.

    Rows are numbered first and compared by that number, so that two texts under one doc_id are two
    documents and a text is only dropped where one of its class stays.
    """
    rows = written(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    classes = near_dup.near_duplicates(rows.where("doc_id IS NOT NULL").select(F.col("_row").alias("doc_id"), "text"))
    members = classes.select(F.col("doc_id").alias("_row"), "class_id").join(rows.select("_row", "doc_id"), "_row")
    first = members.groupBy("class_id").agg(F.min(F.struct("doc_id", "_row")).alias("first")).select("first._row")
    return rows.join(first, "_row", "left_semi").unionByName(rows.where("doc_id IS NULL")).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item, re-parameterised ones included."""
    benchmark = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    bad = decontaminate.contaminated(docs.select("doc_id", "text"), benchmark).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(bad, "doc_id", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 tokens."""
    from cartpath.llm.queries import sequences

    return sequences(docs.select("doc_id", "text"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("best_fit_packing", pack_sequences),
]

# No single SQL statement learns a classifier, estimates similarity or tokenises.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what lies between them is written in the shared folder."""
    docs = read_table(spark, sf_dir, "documents", *COLUMNS)
    for number, (name, stage) in enumerate(STAGES):
        given = docs
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
            if number:
                release(given)
    return docs
