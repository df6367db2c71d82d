"""Quality of a text by a sparse ensemble of rules.

Trees are grown over statistics of the text; each path from a root is a conjunctive rule; a lasso
logistic regression keeps the few rules that matter; and these become one Spark column expression, so
that scoring needs no model object and no Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.llm.common import durable

Condition = tuple[int, bool, float]  # statistic, is at most, threshold
_PARTS = 4  # tasks of each step of learning


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; a null text is an empty one. Shares of nothing are 0."""
    chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    words = F.greatest(F.regexp_count(text, F.lit(r"\S+")), F.lit(1)).cast("double")

    def per(pattern: str, of: Column) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / of

    def share(char: str) -> Column:
        return (F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))) / chars

    distinct = F.size(F.array_distinct(F.split(F.lower(text), r"\s+")))
    return {
        "log_chars": F.log1p(F.char_length(text).cast("double")),
        "chars_per_word": F.char_length(text) / words,
        "symbols": per(r"[^\p{L}\p{N}\s]", chars),
        "upper": per(r"\p{Lu}", chars),
        "digits": per(r"\p{N}", chars),
        "bars": share("|"),
        "exclaims": share("!"),
        "lines_per_word": share("\n") * chars / words,
        "stops_per_word": per(r"[.!?](?=\s|$)", words),
        "distinct_words": distinct / words,
    }


def with_statistics(rows: DataFrame) -> DataFrame:
    """``rows`` with one column ``stats``, an array of the statistics."""
    made = statistics(F.coalesce(F.col("text"), F.lit("")))
    return rows.withColumn("stats", F.array(*(F.coalesce(c.cast("double"), F.lit(0.0)) for c in made.values())))


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; a rule is a conjunction of conditions on statistics."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            total = total + F.when(holds(conditions, stats), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def holds(conditions: tuple[Condition, ...], stats: Column) -> Column:
    parts = [F.get(stats, F.lit(i)) <= t if at_most else F.get(stats, F.lit(i)) > t for i, at_most, t in conditions]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole & part
    return whole


def _paths(node, above: tuple[Condition, ...] = ()) -> Iterator[tuple[Condition, ...]]:
    """Every path from the root to a node, as conditions."""
    if above:
        yield above
    if node.numDescendants():
        split = node.split()
        for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
            yield from _paths(child, (*above, (split.featureIndex(), at_most, split.threshold())))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, trees: int = 24, depth: int = 3, lasso: float = 5e-4) -> RuleModel:
    """Learn from at most ``max_rows`` labelled documents, those with the smallest hash of their id.

    ``labels`` holds doc_id and label, 0 or 1; rows with a null in either are left out, and repeated ids
    take part as often as they occur. With no labelled row, or one class alone, the score is constant.
    """
    chosen = labels.dropna().withColumn("_order", F.xxhash64("doc_id")).orderBy("_order", "doc_id").limit(max_rows)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats = with_statistics(known).select("doc_id", F.col("label").cast("double").alias("label"), "stats")
    # Learning runs some hundred jobs over these few rows; the driver keeps a record of every task and, beyond four
    # or so parts, of an exchange for each job. Adding them up in four parts holds however finely they were dealt out.
    rows = durable(stats.repartition(_PARTS, "doc_id").sortWithinPartitions("doc_id")).coalesce(_PARTS)
    total, good = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < good < total:
        return RuleModel(0.0 if not total else (4.0 if good else -4.0), ())
    width = len(statistics(F.lit("")))
    flat = rows.select("label", *(F.col("stats")[i].alias(f"s{i}") for i in range(width)), "stats")
    vectors = VectorAssembler(inputCols=[f"s{i}" for i in range(width)], outputCol="features").transform(flat)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=7, maxBins=64).fit(vectors)
    rules = sorted({path for tree in forest.trees for path in _paths(tree._call_java("rootNode"))})
    if not rules:
        return RuleModel(0.0, ())
    marks = rows.select("label", *(holds(rule, F.col("stats")).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)))
    marked = durable(VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(marks).select("label", "features"))
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(marked)
    weighted = tuple((rule, float(w)) for rule, w in zip(rules, fitted.coefficients, strict=True) if w)
    return RuleModel(float(fitted.intercept), weighted)


def score(docs: DataFrame, model: RuleModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 at ``threshold`` or more); columns of these names are replaced."""
    names = [n for n in docs.columns if n not in ("score", "predicted")]
    scored = with_statistics(docs.select(*names)).withColumn("score", model.score(F.col("stats")))
    return scored.select(*names, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, by the number of folds, is 0. Null ids are."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))
