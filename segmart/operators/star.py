"""Dimensions and the user fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions.lookups import occupation_category, province_region
from segmart.functions.text import age_bucket
from segmart.operators.joins import lookup_join
from segmart.operators.keys import dense_keys, extend_keys


def dim_user(users: DataFrame) -> DataFrame:
    """Distinct (user_id, name, email)."""
    return users.select(F.col("_id").alias("user_id"), "name", "email").dropDuplicates()


def members(users: DataFrame, column: str | Column, name: str) -> DataFrame:
    """Distinct non-null values of a column."""
    value = F.col(column) if isinstance(column, str) else column
    return users.select(value.alias(name)).where(F.col(name).isNotNull()).distinct()


def described(
    keyed: DataFrame, natural_key: str, name: str, fixed: Column, lookup: DataFrame | None
) -> DataFrame:
    """Add the attribute `name`: from a (key, value) table of any size, else from the fixed map."""
    if lookup is None:
        return keyed.withColumn(name, fixed)
    entries = lookup.groupBy(F.col("key").alias(natural_key)).agg(F.min("value").alias(name))
    joined = lookup_join(keyed, entries, natural_key)
    return joined.select(*keyed.columns, F.coalesce(name, F.lit(fv.OTHER)).alias(name))


def dim_address(
    users: DataFrame, known: DataFrame | None = None, regions: DataFrame | None = None
) -> DataFrame:
    """(address_id, province, region) for any number of provinces.

    With `known`, an earlier dim_address, old members keep their ids. `regions` is a
    (key, value) table in place of the built-in map.
    """
    keyed = keyed_members(members(users, "address", "province"), "province", "address_id", known)
    return described(keyed, "province", "region", province_region(F.col("province")), regions)


def dim_occupation(
    users: DataFrame, known: DataFrame | None = None, categories: DataFrame | None = None
) -> DataFrame:
    """(occupation_id, occupation_name, category); `categories` replaces the built-in map."""
    names = members(users, "occupation", "occupation_name")
    keyed = keyed_members(names, "occupation_name", "occupation_id", known)
    fixed = occupation_category(F.col("occupation_name"))
    return described(keyed, "occupation_name", "category", fixed, categories)


def dim_age_group(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(age_group_id, description)."""
    groups = members(users, age_bucket(F.col("age")), "description")
    return keyed_members(groups, "description", "age_group_id", known)


def keyed_members(new: DataFrame, key: str, id_column: str, known: DataFrame | None) -> DataFrame:
    if known is not None:
        return extend_keys(known.select(id_column, key), new, key, id_column)
    return dense_keys(new, key, id_column)


def repeated_ids(users: DataFrame) -> DataFrame:
    """The ids (`_id`) with more than one (name, email) pair.

    The target's primary key forbids them. Least and greatest pair combine on the map
    side, so an id that holds a third of all rows is no hot spot.
    """
    pair = F.struct("name", "email")
    per_id = users.where(F.col("_id").isNotNull()).groupBy("_id").agg(
        F.min(pair).alias("least"), F.max(pair).alias("greatest")
    )
    return per_id.where(~F.col("least").eqNullSafe(F.col("greatest"))).select("_id")


def fact_rows(
    users: DataFrame,
    address: DataFrame | None = None,
    occupation: DataFrame | None = None,
    age_group: DataFrame | None = None,
) -> DataFrame:
    """One row per user row with an id: user_id, the ids of the given dimensions, gender.

    Every such id is in dim_user, so the inner join with it keeps just these rows. It
    would multiply the rows of an id with several (name, email) pairs; here no row is
    ever multiplied, and `repeated_ids` names such ids.
    """
    rows = users.where(F.col("_id").isNotNull()).select(
        "_id", "gender",
        F.col("address").alias("province"),
        F.col("occupation").alias("occupation_name"),
        age_bucket(F.col("age")).alias("description"),
    )
    lookups = (
        (occupation, "occupation_name", "occupation_id"),
        (address, "province", "address_id"),
        (age_group, "description", "age_group_id"),
    )
    ids = []
    for dimension, natural_key, id_column in lookups:
        if dimension is not None:
            rows = lookup_join(rows, dimension.select(natural_key, id_column), natural_key)
            ids.append(id_column)
    return rows.select(F.col("_id").alias("user_id"), *ids, "gender")


def flat_star(tables: dict[str, DataFrame]) -> DataFrame:
    """The fact with the attributes of all its dimensions, one row per fact row.

    The fact meets dim_user on the user id, of which the least (name, email) counts; the
    other dimensions are lookups.
    """
    flat = tables["fct_user"]
    for name, key in (
        ("dim_address", "address_id"),
        ("dim_occupation", "occupation_id"),
        ("dim_age_group", "age_group_id"),
    ):
        flat = lookup_join(flat, tables[name], key)
    one = tables["dim_user"].groupBy("user_id").agg(F.min(F.struct("name", "email")).alias("u"))
    return flat.join(one.select("user_id", "u.name", "u.email"), "user_id")
