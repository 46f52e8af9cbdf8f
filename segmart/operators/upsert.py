"""Upsert and append over parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.operators.integrity import int_violations, pk_violations, with_int_keys
from segmart.operators.joins import fits_broadcast, lookup_join
from segmart.operators.keys import checked_id, dense_keys
from segmart.session import staged


class DuplicateKeyError(ValueError):
    """The staging rows hold a key twice, or no key."""


def upsert(target: DataFrame, staging: DataFrame, key: str, check: bool = True) -> DataFrame:
    """The target with rows of known keys replaced and rows of new keys added.

    Staging rows must have unique non-null keys, as a conflict clause asks; the
    check shuffles only their key column. The staging rows are written first, as several
    jobs read them. Staging keys of a checked small size are broadcast, and then a target
    of any size is filtered in place.
    """
    staging = staged(staging, "staging")
    if check and not pk_violations(staging, key).isEmpty():
        raise DuplicateKeyError(f"staging rows repeat or lack {key}")
    keys = staging.select(key)
    if fits_broadcast(keys):
        keys = F.broadcast(keys)
    kept = target.join(keys, key, "left_anti").select(*target.columns)
    return staging.select(*target.columns).unionByName(kept)


def upsert_parquet(
    spark: SparkSession, target_path: str, staging: DataFrame, key: str, out_path: str
) -> None:
    """Upsert into a parquet table; the result goes to a folder other than the target's."""
    if out_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("the target is still being read: give another output path")
    merged = upsert(spark.read.parquet(target_path), staging, key)
    merged.write.mode("overwrite").parquet(out_path)


def int_keyed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star tables with integer keys; a key that is no integer is an error."""
    checked = [(name, columns) for name, columns in fv.INTEGER_KEYS.items() if name in tables]
    wrong = [
        int_violations(tables[name], columns).select(F.lit(name).alias("table"), "column_name")
        for name, columns in checked
    ]
    if wrong and (found := reduce(DataFrame.unionByName, wrong).first()):
        raise ValueError(f"keys of {found['table']}.{found['column_name']} that are no INT")
    return {
        name: with_int_keys(table, fv.INTEGER_KEYS.get(name, ())) for name, table in tables.items()
    }


STAR_KEYS = {
    "dim_user": "user_id",
    "dim_address": "address_id",
    "dim_occupation": "occupation_id",
    "dim_age_group": "age_group_id",
    "fct_user": "user_id",
}


# Natural key of each dimension whose ids are given out per star.
NATURAL_KEYS = {
    "dim_address": "province",
    "dim_occupation": "occupation_name",
    "dim_age_group": "description",
}


def merged_ids(target: dict[str, DataFrame], staging: dict[str, DataFrame]) -> DataFrame:
    """(dimension, member, staged_id, id): the target's ids of known members, and new ids for the others.

    The three dimensions go through one numbering: new members are numbered in the order of
    (dimension, member), and each dimension goes on after the highest id it has.
    """
    def members(tables: dict[str, DataFrame], id_column: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            tables[name].select(
                F.lit(name).alias("dimension"), F.col(natural).alias("member"),
                F.col(STAR_KEYS[name]).cast("int").alias(id_column),
            )
            for name, natural in NATURAL_KEYS.items()
        ])

    known = members(target, "known_id")
    found = staged(members(staging, "staged_id").join(known, ["dimension", "member"], "left"), "members")
    new = found.where("known_id IS NULL").select("dimension", "member").distinct()
    numbered = dense_keys(new, ("dimension", "member"), "number", id_type="bigint")
    highest = known.groupBy("dimension").agg(F.max("known_id").alias("top"))
    first = numbered.groupBy("dimension").agg(F.min("number").alias("first"))
    number = F.coalesce("top", F.lit(0)) + F.col("number") - F.col("first") + 1
    # One row per dimension on these two sides.
    new_ids = numbered.join(F.broadcast(first), "dimension").join(F.broadcast(highest), "dimension", "left")
    new_ids = new_ids.select("dimension", "member", checked_id(number, "int").alias("new_id"))
    ids = found.join(new_ids, ["dimension", "member"], "left")
    return staged(
        ids.select("dimension", "member", "staged_id", F.coalesce("known_id", "new_id").alias("id")), "ids"
    )


def rekeyed(target: dict[str, DataFrame], staging: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging star with the target's ids for known members, and new ids for the others.

    Ids of two stars built apart stand for different members; replaced by id alone, facts
    of the target would change their meaning.
    """
    result, ids = dict(staging), merged_ids(target, staging)
    fact = staging["fct_user"]
    for name, natural in NATURAL_KEYS.items():
        key, columns = STAR_KEYS[name], staging[name].columns
        own = ids.where(F.col("dimension") == name)
        new = own.select(F.col("member").alias(natural), F.col("id").alias(key))
        result[name] = staging[name].drop(key).join(new, natural).select(*columns)
        moved = own.select(F.col("staged_id").alias(key), F.col("id").alias("_new"))
        fact = lookup_join(fact, moved, key).withColumn(key, F.col("_new")).drop("_new")
    result["fct_user"] = fact.select(*staging["fct_user"].columns)
    return result


def upsert_star(
    target: dict[str, DataFrame], staging: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Upsert the five star tables, dimensions before the fact.

    User ids are compared as the integers the target declares, and ids of the other
    dimensions by the members they stand for. All checks come before the first result,
    so a faulty batch changes no table.
    """
    types = {name: dict(table.dtypes) for name, table in target.items()}
    target, staging = int_keyed(target), int_keyed(staging)
    staging = rekeyed(target, staging)
    wrong = [
        pk_violations(staging[name], key).select(F.lit(name).alias("table")) for name, key in STAR_KEYS.items()
    ]
    if found := reduce(DataFrame.unionByName, wrong).first():
        name = found["table"]
        raise DuplicateKeyError(f"staging rows of {name} repeat or lack {STAR_KEYS[name]}")
    merged = {
        name: upsert(target[name], staging[name], key, check=False)
        for name, key in STAR_KEYS.items()
    }
    return {
        name: table.select(*[F.col(c).cast(types[name][c]).alias(c) for c in table.columns])
        for name, table in merged.items()
    }
