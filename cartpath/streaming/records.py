"""JSON values out of text files, whatever form a file has: one value per line, an array, or both.

A file is told by its lines. Where most lines are whole objects, each line is a record, and large files are
split over tasks. In other files, such as indented arrays, the values are put together again: inside
JSON a line break only stands between tokens, so the braces of the lines before say whether a line
starts a new element. These sums run over the lines of a file in order, in chunks where a file is
large, so one array of any size is cut into its elements by many tasks.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.operators.skew import HOT_GROUP_ROWS, hot_keys, ordered_context, split_hot
from cartpath.session import written

PATH, BLOCK, FILE = "_path", "_block", "_file"
# What may stand around the elements of an array.
_AROUND = "[], \t\r\n"
# An element of more lines is no event; its lines are records by themselves.
MOST_LINES = 100_000
# Lines of indented files that a task sorts and joins, in the mean. Every line is held for the sums and again for its element.
LINES_PER_TASK = 100_000


def _opened(line: Column) -> Column:
    """Braces that a line opens and leaves open, fewer than none if it closes more; braces in texts do not count."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*+"?', "")
    without = {brace: F.length(F.replace(bare, F.lit(brace), F.lit(""))) for brace in "{}"}
    return (without["}"] - without["{"]).cast("bigint")


def _stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_AROUND))


def indented_files(lines: DataFrame) -> DataFrame:
    """The paths of files of which fewer than half of the lines are whole objects."""
    text = _stripped(F.col("value"))
    whole = F.count_if(text.startswith("{") & text.endswith("}"))
    return lines.groupBy(PATH).agg(F.count("*").alias("_lines"), whole.alias("_whole")).where("2 * _whole < _lines").select(PATH)


def records(
    lines: DataFrame,
    hot_rows: int = HOT_GROUP_ROWS,
    most_lines: int = MOST_LINES,
    lines_per_task: int = LINES_PER_TASK,
) -> DataFrame:
    """value and path of each record, from lines (value, path, and the start of the block a line was read from).

    ``lines`` come in the order of their file within a block, as a text scan gives them. A record is one
    or more whole JSON values with commas and array brackets around, or whatever else a line holds.
    """
    filled = lines.where(F.length(F.trim("value")) > 0)
    # Numbers are only stable once written. That of its file stands for the path, which would be most of a line.
    indented = written(indented_files(filled).withColumn(FILE, F.monotonically_increasing_id()), "indented-files")
    if indented.isEmpty():
        return filled.select("value", PATH)
    by_line = filled.join(indented, PATH, "left_anti").select("value", PATH)
    # Lines are numbered in the order of reading.
    numbered = filled.withColumn("_n", F.monotonically_increasing_id()).join(indented, PATH).drop(PATH)
    numbered = written(numbered.withColumn("_opened", _opened(F.col("value"))), "indented-lines")
    total = numbered.count()
    hot = None if total <= hot_rows else hot_keys(numbered, [FILE], hot_rows)
    tasks = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(total / lines_per_task))
    order = (BLOCK, "_n")
    deep = ordered_context(numbered, [FILE], order, number="_line", running={"_depth": F.col("_opened")}, hot=hot, tasks=tasks)
    starts = (F.col("_depth") <= 0).cast("bigint")
    # Without hot files the lines still lie as they were dealt out for the first sums.
    again = None if hot is None else tasks
    cut = ordered_context(deep, [FILE], order, number="_again", running={"_before": starts}, hot=hot, tasks=again).drop("_again")
    placed = cut.withColumn("_element", F.col("_before") + starts)
    element = [FILE, "_element"]
    whole, endless = split_hot(placed, element, None if hot is None else hot_keys(placed, element, most_lines))
    whole = whole if again is None else whole.repartition(again, *element)
    joined = whole.groupBy(*element).agg(F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("_lines"))
    made = joined.select(F.array_join(F.col("_lines")["value"], "\n").alias("value"), FILE)
    if endless is not None:
        made = made.unionByName(endless.select("value", FILE))
    return by_line.unionByName(made.join(indented, FILE).select("value", PATH))


def decode_records(made: DataFrame, schema: str, corrupt: str, key: str) -> DataFrame:
    """The values of each record by a schema, one row each, with the record's text in ``corrupt`` where there is no ``key``."""
    parsed = F.from_json(F.concat(F.lit("["), _stripped(F.col("value")), F.lit("]")), f"array<struct<{schema}>>")
    found = made.where(F.length(_stripped(F.col("value"))) > 0).select("value", PATH, F.explode_outer(parsed).alias("_one"))
    rejected = F.when(F.col(f"_one.{key}").isNull(), F.col("value")).alias(corrupt)
    return found.select("_one.*", rejected, PATH)
