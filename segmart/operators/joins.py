"""Joins that attach a lookup side: broadcast behind a size check, skew-proof beyond it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmart.session import staged

# Limits of a broadcast side, and the share of the rows that makes a key hot.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1_000


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Row count and approximate data bytes, measured by one aggregate over `df`."""
    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            as_text = F.to_json(F.struct(F.col(field.name)))  # a map or array alone may be null
            return F.coalesce(F.octet_length(as_text), F.lit(0))
        return F.lit(8)

    row_bytes = sum((width(f) for f in df.schema.fields), F.lit(0))
    n_rows, n_bytes = df.agg(F.count("*"), F.sum(row_bytes.cast("bigint"))).first()
    return n_rows, n_bytes or 0


def is_small(n_rows: int, n_bytes: int) -> bool:
    return n_rows <= BROADCAST_ROWS and n_bytes <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    return is_small(*measured_size(df))


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join `rows` with a `lookup` that holds each value of `key` at most once.

    A lookup of a checked small size is broadcast and `rows` stay where they are; an
    empty one needs no join. A larger one goes through `split_hot_join`, and as that
    reads `rows` three times, its result is written for whatever comes next. `how` is
    left, inner, left_semi or left_anti.
    """
    n_rows, n_bytes = measured_size(lookup)
    if n_rows == 0:
        return join_with_nothing(rows, lookup, key, how)
    if is_small(n_rows, n_bytes):
        return rows.join(F.broadcast(lookup), key, how)
    return staged(split_hot_join(rows, lookup, key, how), "joined")


def unmatched(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in `other`; rows with a null key stay.

    An anti join over aggregated rows is moved below the aggregation, and then every
    row of a hot key takes part in it. This form stays where it is written.
    """
    found = other.select(key).withColumn("_found", F.lit(True))
    return rows.join(found, key, "left").where(F.col("_found").isNull()).select(*rows.columns)


def join_with_nothing(rows: DataFrame, lookup: DataFrame, key: str, how: str) -> DataFrame:
    """What `how` yields when the lookup is known to be empty, columns as a join has them."""
    rows = rows.select(key, *[c for c in rows.columns if c != key])
    if how == "left_anti":
        return rows
    if how in ("left_semi", "inner"):
        rows = rows.where(F.lit(False))
    if how == "left_semi":
        return rows
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name != key]
    return rows.select("*", *added)


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than 1/share of the rows: fewer than `share` of them, by counting."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.where(F.col("n") * share > total).select(key)


def split_hot_join(
    rows: DataFrame, lookup: DataFrame, key: str, how: str = "left", share: int = HOT_SHARE
) -> DataFrame:
    """Exact join with a large unique lookup, safe against hot keys.

    Rows of hot keys and of the null key meet a broadcast of the few matching lookup
    rows. All other rows are shuffled, and none of their keys exceeds 1/share of them.
    """
    hot = hot_keys(rows, key, share)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    stays = F.coalesce(F.col("_hot"), F.col(key).isNull())
    hot_lookup = lookup.join(F.broadcast(hot), key, "left_semi")
    near = marked.where(stays).drop("_hot").join(F.broadcast(hot_lookup), key, how)
    far = marked.where(~stays).drop("_hot").join(lookup, key, how)
    return near.unionByName(far)
