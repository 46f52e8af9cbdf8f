"""Constraint checks of the relational schema as jobs that list the violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.operators.joins import unmatched


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """(key, n_rows) of key values that occur more than once, or are null."""
    counted = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | F.col(key).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """(column, n_rows) of values that occur more than once; nulls are allowed."""
    filled = df.where(F.col(column).isNotNull())
    return filled.groupBy(column).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """(fk, n_rows) of foreign-key values without a parent; null keys are allowed.

    Child rows are counted per key before the join, so a key that many of them share
    is one row in it.
    """
    used = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n_rows"))
    return unmatched(used, parent.select(F.col(pk).alias(fk)), fk)


def length_violations(df: DataFrame, key: str, limits: Mapping[str, int]) -> DataFrame:
    """(key, column_name, n_chars, max_chars) of texts above their length limit."""
    checks = F.array(*[
        F.struct(
            F.lit(column).alias("column_name"),
            F.char_length(column).alias("n_chars"),
            F.lit(limit).alias("max_chars"),
        )
        for column, limit in limits.items()
    ])
    too_long = F.col("n_chars") > F.col("max_chars")
    return df.select(F.col(key), F.inline(checks)).where(too_long)


def to_int_key(value: Column) -> Column:
    """The value as INT, null where it is no whole number or out of range."""
    return value.try_cast("int")


def with_int_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame with its key columns as INT."""
    return df.withColumns({c: to_int_key(F.col(c)) for c in columns})


def int_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) of key values that do not fit INT."""
    checks = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.when(to_int_key(F.col(c)).isNull(), F.col(c).cast("string")).alias("value"),
        )
        for c in columns
    ])
    return df.select(F.inline(checks)).where(F.col("value").isNotNull())


PRIMARY_KEYS = {
    "dim_user": "user_id", "dim_occupation": "occupation_id", "dim_age_group": "age_group_id",
    "dim_address": "address_id", "fct_user": "user_id",
}
FOREIGN_KEYS = {
    "user_id": "dim_user", "occupation_id": "dim_occupation", "address_id": "dim_address",
    "age_group_id": "dim_age_group",
}


REPORT_SCHEMA = ("constraint", "table", "column", "n_violations")


def row_check_counts(name: str, table: DataFrame) -> DataFrame:
    """Report rows of the length and integer checks of one table, from a single scan."""
    counts = {
        ("length", column): F.count_if(F.char_length(column) > limit)
        for column, limit in fv.LENGTH_LIMITS[name].items()
    }
    for column in fv.INTEGER_KEYS[name]:
        lost = to_int_key(F.col(column)).isNull() & F.col(column).isNotNull()
        counts["integer", column] = F.count_if(lost)
    totals = table.agg(*[count.alias("_".join(check)) for check, count in counts.items()])
    rows = []
    for kind, column in counts:
        values = (F.lit(kind), F.lit(name), F.lit(column), F.col(f"{kind}_{column}"))
        rows.append(F.struct(*[v.alias(field) for v, field in zip(values, REPORT_SCHEMA)]))
    return totals.select(F.inline(F.array(*rows)))


def star_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(constraint, table, column, n_violations) for every constraint of the star.

    Keys are compared as INT, as the target holds them: `7` and `07` are one key, and
    a text that is no INT is both an integer violation and a missing key.
    """
    typed = {name: with_int_keys(tables[name], fv.INTEGER_KEYS[name]) for name in PRIMARY_KEYS}

    def row(kind: str, table: str, column: str, found: DataFrame) -> DataFrame:
        counted = found.agg(F.count("*").alias("n"))
        return counted.select(*map(F.lit, (kind, table, column)), "n").toDF(*REPORT_SCHEMA)

    report = [row("unique", "dim_user", "email", unique_violations(tables["dim_user"], "email"))]
    for name, key in PRIMARY_KEYS.items():
        report.append(row("primary key", name, key, pk_violations(typed[name], key)))
        report.append(row_check_counts(name, tables[name]))
    for fk, name in FOREIGN_KEYS.items():
        orphans = fk_orphans(typed["fct_user"], fk, typed[name], fk)
        report.append(row("foreign key", "fct_user", fk, orphans))
    return reduce(DataFrame.unionByName, report)
