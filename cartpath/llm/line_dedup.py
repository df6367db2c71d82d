"""Lines that recur across documents, found with levelled sorted runs of line hashes.

Each batch of documents becomes one run: its distinct line keys as 128-bit hashes with the number of
documents and the largest document id, sorted by hash. A run joins the earlier ones by an anti join on
the sorted hashes, which marks the keys that no earlier batch has shown. Runs lie in levels; a level
with ``fanout`` runs is merged into one run of the next, so a new batch meets few runs however many
batches came before. The decision on a line reads the sums over all runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.llm.common import body, durable, release, rows_of, work_path, written

KEY = ["h1", "h2"]
RUN_SCHEMA = "h1 long, h2 long, n_docs long, top_doc long, is_new boolean"
# What is stripped from a line's ends, and the letters that are lowered.
_SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """16 bytes for a line whose stripped text has at least ``min_chars`` code points, else None."""
    key = line.strip(_SPACE)
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.translate(_LOWER))


def line_keys(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """The distinct keys of each document: doc_id, h1, h2, batch."""

    def keys(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(parts):
            ids, found, sizes = [], [], []
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                own = {k for line in text.split(b"\n") if (k := line_key(line, min_chars))}
                found += own
                ids.append(doc_id)
                sizes.append(len(own))
            pairs = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            owners = np.repeat(np.array(ids, np.int64), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["doc_id", *KEY])

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), body().alias("text"))
    hashed = named.mapInArrow(keys, "doc_id long, h1 long, h2 long")
    return hashed.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))


class LineRuns:
    """The levelled runs, below one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 4):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def runs(self) -> DataFrame:
        paths = [path for level in self.levels for path in level]
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], RUN_SCHEMA)

    def _write(self, rows: DataFrame) -> str:
        path = f"{self.folder}/run-{self.written:06d}"
        self.written += 1
        rows.select("h1", "h2", "n_docs", "top_doc", "is_new").sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def add(self, keys: DataFrame) -> DataFrame:
        """Add a batch (doc_id, h1, h2; each document in one batch only) and return its run."""
        summed = keys.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        if any(self.levels):
            known = self.runs().select(*KEY)
            summed = written(summed, "lines")
            fresh = summed.join(known, KEY, "left_anti").withColumn("is_new", F.lit(True))
            again = summed.join(known, KEY, "left_semi").withColumn("is_new", F.lit(False))
            path = self._write(fresh.unionByName(again))
            release(summed)
        else:
            path = self._write(summed.withColumn("is_new", F.lit(True)))
        self.levels[0].append(path)
        self.compact()
        return self.spark.read.schema(RUN_SCHEMA).parquet(path)

    def compact(self) -> None:
        """Merge each full level into one run of the next level."""
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) >= self.fanout:
                merged = self._write(self._sums(self.spark.read.schema(RUN_SCHEMA).parquet(*self.levels[depth])))
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(merged)
                self.levels[depth] = []

    @staticmethod
    def _sums(runs: DataFrame) -> DataFrame:
        return runs.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc"), F.bool_or("is_new").alias("is_new"))

    def frequent(self, min_docs: int) -> DataFrame:
        """The keys found in at least ``min_docs`` documents, with the largest id."""
        return self._sums(self.runs()).where(F.col("n_docs") >= min_docs).select(*KEY, "top_doc")


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, batches: int = 2, fanout: int = 2) -> DataFrame:
    """``docs`` with the text that is left, ``n_lines`` (before) and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs``
    documents stays only in the largest doc_id that holds it; all its lines there stay. Null and empty
    texts are one empty line and give an empty text. Rows with one doc_id are documents of their own
    in the counts, and each keeps its lines if the id is the largest. A row without doc_id is left
    whole and counts nowhere. Input columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    keys = written(line_keys(docs, min_chars, batches), "line-keys")
    runs = LineRuns(spark, work_path(spark, "line-runs"), fanout)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch))
    lost = keys.join(durable(runs.frequent(min_docs)), KEY).where("doc_id <> top_doc")
    lists = lost.groupBy(F.col("doc_id").alias("_lost_doc")).agg(F.collect_set(F.struct(*KEY)).alias("_lost"))

    kept = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped")]
    names = [f.name for f in kept]
    source = docs.select(*(body().alias("text") if n == "text" else F.col(n) for n in names))
    joined = source.join(lists, source["doc_id"] == lists["_lost_doc"], "left").drop("_lost_doc")
    at = names.index("text")

    def rebuild(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(parts):
            texts, counts, drops = [], [], []
            for text, lost in zip(rows.column(at).to_pylist(), rows.column(len(names)).to_pylist(), strict=True):
                lines = text.split(b"\n")
                left = lines
                if lost:
                    gone = {np.array([x["h1"], x["h2"]], np.int64).tobytes() for x in lost}
                    left = [line for line in lines if line_key(line, min_chars) not in gone]
                texts.append(b"\n".join(left))
                counts.append(len(lines))
                drops.append(len(lines) - len(left))
            columns = rows.columns[: len(names)]
            columns[at] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(drops, pa.int64())], names=[*names, "n_lines", "n_dropped"]
            )

    out = source.select(*names).schema.add("n_lines", "long").add("n_dropped", "long")
    rebuilt = joined.mapInArrow(rebuild, out)
    return rebuilt.withColumn("text", F.col("text").cast("string"))


