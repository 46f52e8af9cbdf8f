"""De-duplication by key with a fixed choice of the survivor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmart.functions.text import numeric_id
from segmart.operators.joins import fits_broadcast, unmatched
from segmart.session import staged


def lowest_per_key(df: DataFrame, key: str, id_column: str) -> DataFrame:
    """One row per key: the lowest numeric id, then the lowest id text, then the other columns.

    Null keys form one group. One aggregation whose partial step leaves at most one
    row per key and task, so a key that holds a third of all rows is no hot spot.
    """
    number = numeric_id(F.col(id_column))
    rest = [c for c in df.columns if c not in (key, id_column)]
    order = [number.isNull().alias("_text"), number.alias("_number")]
    survivor = F.min(F.struct(*order, id_column, *rest)).alias("_row")
    picked = df.groupBy(key).agg(survivor)
    return picked.select(*[key if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_email(users: DataFrame) -> DataFrame:
    """One cleaned user per e-mail."""
    return lowest_per_key(users, "email", "_id")


def accepted_rows(target: DataFrame, batch: DataFrame, key: str = "_id") -> DataFrame:
    """The rows of `batch` that an insert-ignore adds to `target`.

    Keys the target holds are left out; of a key repeated in the batch the lowest
    row goes in. Rows without a key cannot collide and all go in. Appending the
    result leaves the target's own files untouched. The batch is written first, as
    several jobs read it. A batch of a checked small size is broadcast to the target,
    which is then scanned but not shuffled.
    """
    batch = staged(batch, "batch")
    keyed = batch.where(F.col(key).isNotNull())
    rest = [c for c in batch.columns if c != key]
    if rest:
        lowest = keyed.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
        once = lowest.select(*[key if c == key else F.col(f"_row.{c}").alias(c) for c in batch.columns])
    else:
        once = keyed.distinct()
    keyless = batch.where(F.col(key).isNull())
    if target.isEmpty():
        return once.unionByName(keyless)
    known = target.select(key)
    if fits_broadcast(keyed.select(key)):
        known = known.join(F.broadcast(once.select(key)), key, "left_semi")
    # A key that the target repeats must not be a hot key of the join below.
    return unmatched(once, known.distinct(), key).unionByName(keyless)


def insert_ignore(target: DataFrame, batch: DataFrame, key: str = "_id") -> DataFrame:
    """The target after inserting the batch, rows of known keys rejected."""
    return target.unionByName(accepted_rows(target, batch, key))
