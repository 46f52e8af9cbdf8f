"""Raw users derived from the customer table, one per customer, with faults by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart.functions.documents import to_documents
from segmart.sources.landing import to_landing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_remainder(key: Column, divisor: int, values: dict[int, str], other: Column | str) -> Column:
    """Text by `key % divisor`, `other` for remainders that are not listed."""
    chosen = None
    for remainder, value in values.items():
        condition = key % divisor == remainder
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen.otherwise(other)


def users_from_keys(rows: DataFrame, key: str, name: str) -> DataFrame:
    k = F.col(key).cast("bigint")
    address = ["Hà Nội", "An Giang", " Cà Mau ", "Atlantis", "", "Gia Lai", "Nghệ An", "Lào Cai", "Sơn La"]
    occupation = ["Bác sĩ", "Y tá", "Kỹ sư phần mềm", "Giáo viên", "", "Nông dân", "Kế toán", "Sinh viên"]
    gender = ["boy", "girl", "malee", "", "MALE", "female", "Other", "??", "Female"]
    age = ["abc", "-5", "999", "", "0", "18.7", " 42 "]
    date = ["", "32/13/2025", "2025-07-04", "abc"]
    own_email = F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com"))
    next_email = F.concat(F.lit("user"), (k + 1).cast("string"), F.lit("@example.com"))
    return rows.select(
        k.cast("string").alias("id"),
        F.when(k % 97 == 0, "").otherwise(F.col(name)).alias("name"),
        F.when(k % 89 == 0, "").when(k % 83 == 0, "not-an-email")
        .when(k % 13 == 0, next_email).otherwise(own_email).alias("email"),
        F.when(k % 7 == 0, "")
        .otherwise(F.concat(F.lit("09"), (10_000_000 + k).cast("string"))).alias("phone"),
        by_remainder(k, 11, dict(enumerate(gender)), "Male").alias("gender"),
        by_remainder(k, 23, dict(enumerate(age)), (k % 120 + 1).cast("string")).alias("age"),
        by_remainder(k, 10, dict(enumerate(address)), "Tây Ninh").alias("address"),
        by_remainder(k, 9, dict(enumerate(occupation)), "Công an").alias("occupation"),
        by_remainder(k, 19, dict(enumerate(date)), "04/07/2025").alias("register_date"),
    )


def users_raw(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One user per customer. Spread over all cores if asked: a million customers may be one row group, and one task."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    if spread:
        customers = customers.repartition(spark.sparkContext.defaultParallelism)
    return users_from_keys(customers, "c_custkey", "c_name")


def landing(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The raw users as landing rows: one JSON document per row."""
    return to_landing(to_documents(users_raw(spark, sf_dir, spread)))
