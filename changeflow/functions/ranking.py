"""First rows and dense numbering inside a group, without loading one task with a hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only the first row of each key in every task before the shuffle (WindowGroupLimit),
    so a key that holds a third of all rows sends one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def dense_position(
    df: DataFrame, group: list[str], key: str, ties: list[str] = (), name: str = "pos", total: str | None = None
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 ... in key order.

    A plain ``row_number`` over the group would sort a hot group in one task. Here rows are dealt into
    ranges of (group, key, ties), each task sorts its range and writes it once, with the row's place
    in the task. A group's rows lie together in a task, so a row's position is its place after the
    group's first row there, plus the group's rows in earlier ranges: a table of one row per task
    and group, which is stored and joined. Only rows alike in group, key and ties must share a task.
    ``total`` names a column for the size of the group.
    """
    order = [*group, key, *ties]
    place = F.monotonically_increasing_id()
    placed = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    placed = placed.withColumn("_task", F.shiftright("_place", 33))
    runs = placed.groupBy("_task", *group).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    in_order = Window.partitionBy(*group).orderBy("_task")
    before = F.sum("_rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_before", F.coalesce(before, F.lit(0)))
    if total:
        runs = runs.withColumn(total, F.sum("_rows").over(Window.partitionBy(*group)))
    runs = settle(runs.drop("_rows"))
    same = [placed["_task"] == runs["_task"], *[placed[c].eqNullSafe(runs[c]) for c in group]]
    position = placed["_place"] - runs["_first"] + runs["_before"] + 1
    return placed.join(runs, same).select(
        *[placed[c] for c in df.columns], position.alias(name), *([runs[total]] if total else [])
    )
