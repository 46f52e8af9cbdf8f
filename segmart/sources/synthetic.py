"""Synthetic dirty users: every field is an expression of the row's key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions.text import email_slug, phone_format, register_date

# The picks are arithmetic on the key, so a re-run task gives the same rows.
PRIME = 1_000_003
MULTIPLIERS = {
    "gender": 7_919, "family": 15_485_863, "middle": 104_729, "given_1": 1_299_709,
    "given_2": 86_028_121, "prefix": 611_953, "digits": 32_452_843, "age": 49_979_687,
    "address": 67_867_967, "occupation": 224_737, "date": 350_377, "bad_gender": 746_773,
    "bad_age": 882_377, "missing": 2_750_159, "bad_date": 3_497_861, "count": 4_256_233,
    "subset": 5_800_079, "source": 6_461_335,
}

GENDER_BIT, AGE_BIT, MISSING_BIT, DATE_BIT = 1, 2, 4, 8
PAIRS = (3, 5, 6, 9, 10, 12)
TRIPLES = (7, 11, 13, 14)
ALL_FOUR = 15
SINGLE_ERRORS = {
    "bad_gender": GENDER_BIT, "bad_age": AGE_BIT, "missing_fields": MISSING_BIT,
    "bad_register_date": DATE_BIT,
}


def pick(key: Column, purpose: str, n: int) -> Column:
    """A number in 0..n-1 that looks random over keys and differs per purpose."""
    multiplier = MULTIPLIERS[purpose]
    return (key % PRIME * multiplier + multiplier % 9_973) % PRIME % n


def pick_from(key: Column, purpose: str, values: Sequence[str]) -> Column:
    choices = F.array(*[F.lit(v) for v in values])
    return F.get(choices, pick(key, purpose, len(values)).cast("int"))


def full_name(key: Column) -> Column:
    """Family, middle and given names; the middle list follows the gender."""
    middle_name = (
        F.when(gender_of(key) == "Male", pick_from(key, "middle", fv.MIDDLE_NAMES_MALE))
        .when(gender_of(key) == "Female", pick_from(key, "middle", fv.MIDDLE_NAMES_FEMALE))
        .otherwise(pick_from(key, "middle", fv.MIDDLE_NAMES_MALE + fv.MIDDLE_NAMES_FEMALE))
    )
    return F.concat_ws(
        " ",
        pick_from(key, "family", fv.FAMILY_NAMES),
        middle_name,
        pick_from(key, "given_1", fv.GIVEN_NAMES),
        pick_from(key, "given_2", fv.GIVEN_NAMES),
    )


def gender_of(key: Column) -> Column:
    return pick_from(key, "gender", fv.GENDERS)


def phone_of(key: Column) -> Column:
    number = (10_000_000 + pick(key, "digits", PRIME) * 89).cast("string")
    return phone_format(F.concat(pick_from(key, "prefix", fv.PHONE_PREFIXES), number))


def error_bits(key: Column, error_class: Column) -> Column:
    """Which faults a row carries; a multi-error row gets two to four distinct ones."""
    size = pick(key, "count", 3)
    several = (
        F.when(size == 0, F.get(F.array(*map(F.lit, PAIRS)), pick(key, "subset", 6).cast("int")))
        .when(size == 1, F.get(F.array(*map(F.lit, TRIPLES)), pick(key, "subset", 4).cast("int")))
        .otherwise(ALL_FOUR)
    )
    bits = F.when(error_class == "multi_error", several)
    for name, bit in SINGLE_ERRORS.items():
        bits = bits.when(error_class == name, bit)
    return bits.otherwise(0)


def dirty_users(
    rows: DataFrame,
    as_of: date | Column,
    cities: Sequence[str] = fv.PROVINCES,
) -> DataFrame:
    """Nine text columns and the error class, one row per (key, error_class, valid_key).

    `valid_key` is the key of the valid row whose e-mail a duplicate repeats, null
    where there is none. No shuffle: the e-mail is recomputed from that key.
    """
    key, kind = F.col("key"), F.col("error_class")
    drawn = rows.withColumn("bits", error_bits(key, kind))

    def has(bit: int) -> Column:
        return F.col("bits").bitwiseAND(bit) != 0

    lost_address = has(MISSING_BIT) & (pick(key, "missing", 2) == 0)
    lost_occupation = has(MISSING_BIT) & (pick(key, "missing", 2) == 1)
    email_key = F.when(kind == "duplicate", F.coalesce(F.col("valid_key"), key)).otherwise(key)
    days_back = pick(key, "date", fv.REGISTER_DATE_SPAN_DAYS + 1).cast("int")
    return drawn.select(
        key.cast("string").alias("id"),
        full_name(key).alias("name"),
        email_slug(full_name(email_key)).alias("email"),
        phone_of(key).alias("phone"),
        F.when(has(GENDER_BIT), pick_from(key, "bad_gender", fv.BAD_GENDERS))
        .otherwise(gender_of(key)).alias("gender"),
        F.when(has(AGE_BIT), pick_from(key, "bad_age", fv.BAD_AGES))
        .otherwise(pick(key, "age", 121).cast("string")).alias("age"),
        F.when(lost_address, "").otherwise(pick_from(key, "address", cities)).alias("address"),
        F.when(lost_occupation, "")
        .otherwise(pick_from(key, "occupation", fv.OCCUPATIONS)).alias("occupation"),
        F.when(has(DATE_BIT), pick_from(key, "bad_date", fv.BAD_REGISTER_DATES))
        .otherwise(register_date(as_of, days_back)).alias("register_date"),
        kind,
    )


def synth_users(
    spark: SparkSession,
    counts: Mapping[str, int],
    as_of: date,
    cities: Sequence[str] = fv.PROVINCES,
) -> DataFrame:
    """`counts[c]` users of each error class, ids from 1 in the order of the classes."""
    check_classes(counts)
    key, first, bounds = F.col("key"), 1, []
    for name in fv.ERROR_CLASSES:
        first += counts.get(name, 0)
        bounds.append((first, name))
    kind = F.lit(None).cast("string")
    for bound, name in reversed(bounds):
        kind = F.when(key < bound, name).otherwise(kind)
    valid = counts.get("valid", 0)
    valid_key = 1 + pick(key, "source", PRIME) % valid if valid else F.lit(None).cast("bigint")
    rows = spark.range(1, first).select(
        F.col("id").alias("key"), kind.alias("error_class"), valid_key.alias("valid_key")
    )
    return dirty_users(rows, as_of, cities)


def inject_errors(
    base: DataFrame,
    key: str,
    shares: Mapping[str, int],
    as_of: date,
    cities: Sequence[str] = fv.PROVINCES,
) -> DataFrame:
    """One user per row of `base`; within each run of sum(shares) keys, `shares[c]` of class c."""
    check_classes(shares)
    total = sum(shares.values())
    place = F.col("key") % total
    kind, start = F.lit(None).cast("string"), total
    for name in reversed(fv.ERROR_CLASSES):
        kind = F.when(place < start, name).otherwise(kind)
        start -= shares.get(name, 0)
    valid = shares.get("valid", 0)
    block_start = F.col("key") - place
    valid_key = (
        block_start + pick(F.col("key"), "source", valid) if valid else F.lit(None).cast("bigint")
    )
    rows = base.select(F.col(key).cast("bigint").alias("key")).select(
        "key", kind.alias("error_class"), valid_key.alias("valid_key")
    )
    return dirty_users(rows, as_of, cities)


def check_classes(sizes: Mapping[str, int]) -> None:
    unknown = set(sizes) - set(fv.ERROR_CLASSES)
    if unknown:
        raise ValueError(f"unknown error classes: {sorted(unknown)}")


def error_class_counts(users: DataFrame) -> DataFrame:
    """Rows per error class, and their total as class `total`."""
    return (
        users.rollup("error_class")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("error_class", F.coalesce("error_class", F.lit("total")))
    )
