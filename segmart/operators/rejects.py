"""What the strict profile rejects, and why: every landing row with one bit per failed rule.

The rows that pass and the rows that do not come out of one parse, and one write puts them
into two folders, so nothing vanishes: kept + rejected = landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions.documents import is_json_null, try_parse_documents
from segmart.functions.text import null_if_empty, strip
from segmart.operators import rules

# Bit 0 is the first. A text that is no JSON object fails this rule alone.
RULES = ("unreadable", "_id", "name", "email", "gender", "age", "address")
REJECTED, FAIL_BITS, SOURCE = "rejected", "fail_bits", "source"


def fail_bits() -> Column:
    """The rules of the strict profile that a parsed row breaks, from the columns of `ledger`."""
    document, gender, age = F.col("document"), F.col("document.gender"), F.col("document.age")
    missing_age = age.isNull() | is_json_null(age)
    wrong = {
        "_id": ~rules.is_filled(F.col("document._id")),
        "name": ~rules.is_filled(F.col("document.name")),
        "email": ~rules.is_filled(F.col("document.email")),
        "gender": rules.is_filled(gender) & F.col("_gender").isNull(),
        "age": ~missing_age & ~rules.is_valid_age(F.col("_age")),
        "address": F.col("_address").isNotNull() & ~F.col(rules.ADDRESS_KNOWN),
    }
    bits = sum((F.when(broken, 1 << RULES.index(name)).otherwise(0) for name, broken in wrong.items()), F.lit(0))
    return F.when(document.isNull(), 1).otherwise(bits)


def reasons(bits: Column) -> Column:
    """The names of the broken rules."""
    named = [F.when(bits.bitwiseAND(1 << i) != 0, F.lit(name)) for i, name in enumerate(RULES)]
    return F.array_compact(F.array(*named))


def ledger(
    landing: DataFrame,
    provinces: rules.Provinces = fv.PROVINCES,
    column: str = fv.LANDING_COLUMN,
    source: Column | None = None,
) -> DataFrame:
    """Every landing row: its record as the strict profile has it, its text, source and broken rules.

    `source` says where a row came from, such as `_metadata.file_path` of landing files.
    """
    named = landing.select(F.col(column), (F.lit(None).cast("string") if source is None else source).alias(SOURCE))
    rows = try_parse_documents(named, column, fv.CLEAN_FIELDS, ["age"])
    rows = rules.mark_known_address(rows, provinces, F.col("document.address")).select(
        "*",
        rules.whole_number(F.col("document.age")).alias("_age"),
        rules.canonical_gender(F.col("document.gender")).alias("_gender"),
        strip(null_if_empty(F.col("document.address"))).alias("_address"),
    )
    rows = rows.withColumn(FAIL_BITS, fail_bits())
    return rows.select(
        *[F.col(f"document.{field}").alias(field) for field in ("_id", "name", "email", "phone")],
        F.col("_gender").alias("gender"), F.col("_age").alias("age"), F.col("_address").alias("address"),
        rules.with_default(F.col("document.occupation"), "").alias("occupation"),
        F.col(FAIL_BITS), F.col(column), F.col(SOURCE), (F.col(FAIL_BITS) != 0).alias(REJECTED),
    )


def write_ledger(rows: DataFrame, root: str) -> None:
    """Both kinds of rows by one job, each to its own folder. A kept row's text is left out."""
    text = next(c for c in rows.columns if c not in (*fv.CLEAN_FIELDS, FAIL_BITS, SOURCE, REJECTED))
    slim = rows.withColumn(text, F.when(F.col(REJECTED), F.col(text)))
    slim.write.mode("overwrite").partitionBy(REJECTED).parquet(root)


def read_kept(spark: SparkSession, root: str) -> DataFrame:
    """The records that passed, in the eight clean columns."""
    return _read(spark, root, fv.CLEAN_SCHEMA).where(~F.col(REJECTED)).drop(REJECTED)


def read_rejected(spark: SparkSession, root: str, column: str = fv.LANDING_COLUMN) -> DataFrame:
    """The rejected rows: source, text, id, broken rules as bits and as names."""
    found = _read(spark, root, f"_id string, `{column}` string, {FAIL_BITS} int, {SOURCE} string")
    bits = F.col(FAIL_BITS)
    return found.where(F.col(REJECTED)).select(SOURCE, column, "_id", FAIL_BITS, reasons(bits).alias("reasons"))


def _read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {REJECTED} boolean").parquet(root)
