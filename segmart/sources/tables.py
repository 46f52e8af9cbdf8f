"""Parquet tables: run-date partitions, whole tables, the star as a set of tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.session import at_once

DATE_COLUMN = "dt"
STAR_TABLES = ("dim_user", "dim_address", "dim_occupation", "dim_age_group", "fct_user")
INSIGHT_TABLE = "user_segment_insight"


def with_load_date(df: DataFrame, run_date: date | None = None) -> DataFrame:
    """Stamp rows with the run date, today where none is given."""
    return df.withColumn(DATE_COLUMN, F.lit(run_date) if run_date else F.current_date())


def write_by_date(
    df: DataFrame, root: str, overwrite: str = "dynamic", rebalance: bool = False
) -> None:
    """Overwrite the date partitions of `root` that occur in `df`; other dates stay.

    `overwrite="static"` empties the whole table first. For one run date no shuffle
    is needed. `rebalance` is for frames with many dates: it groups rows by date so
    that few files are written, and splits large dates over several tasks.
    """
    if rebalance:
        df = df.hint("rebalance", DATE_COLUMN)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(DATE_COLUMN).parquet(root)


def write_run_date(df: DataFrame, root: str, run_date: date) -> None:
    """Replace one date's partition by `df`, also where `df` is empty; other dates stay."""
    df.write.mode("overwrite").parquet(f"{root}/{DATE_COLUMN}={run_date.isoformat()}")


def read_run_date(
    spark: SparkSession,
    root: str,
    run_date: date | None = None,
    schema: str = fv.CLEAN_SCHEMA,
    keep_date: bool = False,
) -> DataFrame:
    """Rows of one date partition; a date that was never written is an error.

    So are files that lack a column of the schema: the reader would fill it with nulls.
    Only the directory of that date is listed, whatever the number of dates.
    """
    run_date = run_date or date.today()
    held = set(spark.read.parquet(f"{root}/{DATE_COLUMN}={run_date.isoformat()}").columns)
    wanted = spark.createDataFrame([], schema).columns
    missing = [name for name in wanted if name not in held]
    if missing:
        raise ValueError(f"the files of {root} for {run_date} lack {missing}: they hold {sorted(held)}")
    reader = spark.read.option("basePath", root).schema(f"{schema}, {DATE_COLUMN} date")
    rows = reader.parquet(f"{root}/{DATE_COLUMN}={run_date.isoformat()}")
    return rows if keep_date else rows.drop(DATE_COLUMN)


def read_dates(spark: SparkSession, root: str, first: date, last: date) -> DataFrame:
    """Rows of a range of dates; other partitions are pruned."""
    rows = spark.read.parquet(root)
    return rows.where(F.col(DATE_COLUMN).between(F.lit(first), F.lit(last)))


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Write each table to its own folder below `root`; the tables do not depend on each other."""
    steps = {
        name: partial(table.write.mode(mode).parquet, f"{root}/{name}") for name, table in tables.items()
    }
    if steps:
        at_once(next(iter(tables.values())).sparkSession, steps)


def read_tables(
    spark: SparkSession, root: str, names: tuple[str, ...] = STAR_TABLES
) -> dict[str, DataFrame]:
    """Read whole tables: every part file of each folder."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}
