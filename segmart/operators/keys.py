"""Dense integer keys for dimension members: 1, 2, 3, ... in the order of the natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmart.operators.joins import unmatched
from segmart.session import shared_dir

ROW_BITS = 33


def checked_id(number: Column, id_type: str) -> Column:
    """The number as the id type; a number beyond its range fails the job."""
    if id_type != "int":
        return number.cast(id_type)
    too_large = F.raise_error(F.lit("more members than INT keys"))
    return F.when(number > 2**31 - 1, too_large.cast("int")).otherwise(number.try_cast("int"))


def dense_keys(
    members: DataFrame,
    key: str | Sequence[str],
    id_column: str,
    after: int | Column = 0,
    id_type: str = "int",
) -> DataFrame:
    """Keys `after`+1, `after`+2, ... for any number of distinct members, null keys first.

    One range shuffle sorts the members over all tasks. Each row notes its place
    within its task, the checkpoint freezes task numbers and places, and one total
    per task gives the offsets to add. The ids depend on the members alone, not on
    the number of tasks. The broadcast offsets have one row per task.
    """
    shared_dir(members.sparkSession)
    order = [key] if isinstance(key, str) else list(key)
    placed = (
        members.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    task = F.shiftrightunsigned("_place", ROW_BITS).alias("_task")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(task)
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    start = after if isinstance(after, Column) else F.lit(after)
    row = F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    number = start + F.col("_offset") + row + 1
    return (
        placed.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .select(checked_id(number, id_type).alias(id_column), *members.columns)
    )


def extend_keys(
    known: DataFrame, members: DataFrame, key: str, id_column: str, id_type: str = "int"
) -> DataFrame:
    """`known` ids unchanged, and new members numbered after the highest of them.

    Members that no longer occur keep their row, so old facts still resolve.
    """
    new = unmatched(members, known, key)
    highest = known.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).scalar()
    return known.unionByName(dense_keys(new, key, id_column, after=highest, id_type=id_type))
