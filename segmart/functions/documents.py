"""JSON documents: guarded parsing, building and type inspection."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmart.functions.text import null_if_blank

JSON_OPTIONS = {"allowSingleQuotes": "false"}


def document_schema(fields: Collection[str], variants: Collection[str] = ()) -> str:
    """DDL of a document: text fields, or VARIANT where null, absent and type matter."""
    return ", ".join(f"`{f}` {'variant' if f in variants else 'string'}" for f in fields)


def parsed_list(text: Column, schema: str) -> Column:
    """The text followed by one empty object, parsed together as a JSON array.

    The array has exactly two elements if and only if the text is one complete
    JSON value. Parsed alone, trailing garbage after the first value would pass.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(",{}]"))
    return F.from_json(wrapped, f"array<struct<{schema}>>", JSON_OPTIONS)


def parse_documents(
    df: DataFrame,
    column: str,
    fields: Collection[str],
    variants: Collection[str] = (),
    keep: Collection[str] = (),
) -> DataFrame:
    """One row per JSON object in `column`; null, malformed and non-object texts drop out.

    The rows come out of a generator, so later filters cannot be pushed below the
    parse. A plain filter on a parsed field would be, and would parse every text
    once more per condition.
    """
    parsed = df.select(*keep, parsed_list(F.col(column), document_schema(fields, variants)).alias("_p"))
    is_object = (F.size("_p") == 2) & F.get("_p", F.lit(0)).isNotNull()
    return parsed.select(*keep, F.inline(F.when(is_object, F.slice("_p", 1, 1))))


def try_parse_documents(
    df: DataFrame, column: str, fields: Collection[str], variants: Collection[str] = ()
) -> DataFrame:
    """All rows of `df` plus struct `document`, null where the text is no JSON object."""
    schema = document_schema(fields, variants)
    parsed = df.withColumn("_p", parsed_list(F.col(column), schema))
    return parsed.withColumn(
        "document", F.when(F.size("_p") == 2, F.get("_p", F.lit(0)))
    ).drop("_p")


def variant_text(value: Column) -> Column:
    """Text of a variant: strings as they are, other values as JSON text, JSON null as null."""
    return F.try_variant_get(value, "$", "string")


def is_json_null(value: Column) -> Column:
    """True where the key is present with a JSON null."""
    return F.is_variant_null(value)


def record_to_json(*columns: Column | str, keep_nulls: bool = False) -> Column:
    """JSON text of the columns; null columns are left out unless asked for."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def to_documents(users: DataFrame, column: str = "document") -> DataFrame:
    """One JSON document per user row: blank fields left out, `id` called `_id`."""
    fields = [
        null_if_blank(F.col(f)).alias("_id" if f == "id" else f)
        for f in users.columns
    ]
    return users.select(record_to_json(*fields).alias(column))


def infer_schema(df: DataFrame, column: str) -> DataFrame:
    """One row with the merged type of all documents in `column`.

    Reads the whole column with partial aggregation, where looking at a first
    record would let one null or one stray number decide.
    """
    variant = F.try_parse_json(F.col(column))
    return df.select(F.schema_of_variant_agg(variant).alias("schema"))


def schema_census(df: DataFrame, column: str) -> DataFrame:
    """Rows (key, json_type, n_docs): how many documents hold each key with each type."""
    as_map = F.from_json(F.col(column), "map<string,variant>", JSON_OPTIONS)
    return (
        df.select(F.explode(as_map).alias("key", "value"))
        .groupBy("key", F.schema_of_variant("value").alias("json_type"))
        .agg(F.count("*").alias("n_docs"))
    )


def column_types(df: DataFrame, column: str) -> DataFrame:
    """Distinct SQL type names of a column."""
    return df.select(F.typeof(F.col(column)).alias("type")).distinct()
