"""Reference lists and lookup maps, from files or from the fixed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv


def read_city_list(
    spark: SparkSession, path: str, fallback: Sequence[str] | None = None
) -> DataFrame:
    """One-column table `city` from a CSV file with that header.

    Read once per job. A missing file is an error unless a fallback is given.
    """
    try:
        return spark.read.option("header", "true").csv(path).select("city")
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return city_list(spark, fallback)


def bounded_values(table: DataFrame, max_values: int = 10_000) -> list[str]:
    """The values of a one-column list on the driver; a longer list is an error."""
    rows = table.take(max_values + 1)
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} values")
    return [row[0] for row in rows]


def city_list(spark: SparkSession, cities: Sequence[str] = fv.PROVINCES) -> DataFrame:
    """One-column table `city` as a literal of the plan."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, cities))).alias("city"))


# A file with one JSON object is one value of one task, so its size is bounded.
MAX_OBJECT_BYTES = 64 << 20


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Two-column table (key, value) from a file that holds one JSON object of texts.

    A larger file than `MAX_OBJECT_BYTES` is an error; `read_lookup_lines` has no limit.
    """
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    if (largest or 0) > MAX_OBJECT_BYTES:
        raise ValueError(f"{path} has {largest} bytes: write one pair per line instead")
    text = spark.read.text(path, wholetext=True)
    return lookup_entries(text, "value")


def read_lookup_lines(spark: SparkSession, path: str) -> DataFrame:
    """Two-column table (key, value) from files with one JSON object `{"key": .., "value": ..}` a line.

    Files of any size are split over tasks. A line that is no such object is an error.
    """
    return spark.read.schema("key string, value string").option("mode", "FAILFAST").json(path)


def write_lookup_lines(pairs: DataFrame, path: str) -> None:
    """(key, value) rows to such files, in parallel."""
    pairs.select("key", "value").write.mode("overwrite").json(path)


def lookup_entries(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Rows (key, value) of the JSON objects in `column`, after the columns to keep."""
    as_map = F.from_json(F.col(column), "map<string,string>")
    return df.select(*keep, F.explode(as_map).alias("key", "value"))


def lookup_table(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """Two-column table (key, value) as a literal of the plan."""
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return spark.range(1).select(F.explode(F.create_map(*pairs)).alias("key", "value"))
