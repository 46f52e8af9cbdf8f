"""Cleaning rules and the three profiles built from them.

strict    a required field missing, or any value wrong, drops the row
sentinel  missing values get markers, wrong values drop the row
tag       no row is dropped, wrong values are overwritten with markers
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions.documents import (
    JSON_OPTIONS, is_json_null, parse_documents, try_parse_documents, variant_text,
)
from segmart.functions.text import looks_like_email, null_if_empty, parse_int, strip
from segmart.operators.joins import lookup_join

Provinces = Sequence[str] | DataFrame
ADDRESS_KNOWN = "_address_known"
LISTED = "_listed"


# -- single rules ---------------------------------------------------------------

def is_filled(text: Column) -> Column:
    """Required field: present and not empty."""
    return F.coalesce(text != "", F.lit(False))


def with_default(value: Column, default: str) -> Column:
    """Optional field: the value, or a default where the key is absent."""
    return F.coalesce(value, F.lit(default))


def valid_email_or_tag(email: Column) -> Column:
    return F.when(looks_like_email(email), email).otherwise(fv.NOT_AVAILABLE)


def nickname_gender(gender: Column) -> Column:
    """Male for boy and Female for girl in any case, else null."""
    lower = F.lower(gender)
    return F.when(lower == "boy", "Male").when(lower == "girl", "Female")


def is_known_gender(gender: Column) -> Column:
    return F.coalesce(F.lower(gender).isin("male", "female", "other", "boy", "girl"), F.lit(False))


def canonical_gender(gender: Column) -> Column:
    """Male, Female or Other for a known gender in any case; null for an empty one."""
    lower = F.lower(gender)
    named = F.when(lower.isin("male", "female", "other"), F.initcap(lower))
    return F.coalesce(nickname_gender(gender), named)


def gender_as_typed(gender: Column) -> Column:
    """Nicknames replaced, other known genders with the case they came in."""
    return F.coalesce(nickname_gender(gender), F.when(is_known_gender(gender), gender))


def gender_or_tag(gender: Column) -> Column:
    exact = F.when(gender.isin(*fv.GENDERS), gender)
    return F.coalesce(nickname_gender(gender), exact, F.lit(fv.NOT_AVAILABLE))


def whole_number(value: Column) -> Column:
    """Whole number from a JSON text, number (cut to whole) or boolean, else null."""
    number = F.try_variant_get(value, "$", "double").try_cast("int")
    not_text = F.schema_of_variant(value) != "STRING"
    return F.coalesce(parse_int(variant_text(value)), F.when(not_text, number))


def is_valid_age(number: Column) -> Column:
    return F.coalesce(number.between(1, 120), F.lit(False))


def valid_age(number: Column) -> Column:
    """The number where it is an age, else null."""
    return F.when(is_valid_age(number), number)


def is_province(address: Column, provinces: Sequence[str] = fv.PROVINCES) -> Column:
    """Membership of the trimmed address in the province list, false for null."""
    return F.coalesce(strip(address).isin(list(provinces)), F.lit(False))


def mark_known_address(rows: DataFrame, provinces: Provinces, address: Column) -> DataFrame:
    """Add a boolean: is the trimmed address on the list.

    A Python list becomes a hash-set test inside the scan stage. A table is joined,
    by broadcast if its measured size allows.
    """
    if not isinstance(provinces, DataFrame):
        return rows.withColumn(ADDRESS_KNOWN, is_province(address, provinces))
    listed = listed_provinces(provinces).withColumn("_hit", F.lit(True))
    joined = lookup_join(rows.withColumn(LISTED, strip(address)), listed, LISTED, "left")
    return joined.withColumn(ADDRESS_KNOWN, F.coalesce("_hit", F.lit(False))).drop("_hit", LISTED)


def listed_provinces(provinces: DataFrame) -> DataFrame:
    names = provinces.select(F.col(provinces.columns[0]).alias(LISTED))
    return names.where(F.col(LISTED).isNotNull()).distinct()


def valid_province_rows(rows: DataFrame, provinces: DataFrame, column: str = "address") -> DataFrame:
    """Rows whose trimmed address is on the list: a semi join."""
    trimmed = rows.withColumn(LISTED, strip(F.col(column)))
    return lookup_join(trimmed, listed_provinces(provinces), LISTED, "left_semi").drop(LISTED)


# -- profiles -------------------------------------------------------------------

def emit(rows: DataFrame, passes: Column, *outputs: Column | str) -> DataFrame:
    """The rows that pass, with the given columns.

    The same as a filter and a projection, but neither moves: values derived in the
    step before are computed once per row. A filter on them would be pushed below
    that step, together with a second copy of their expressions.
    """
    return rows.select(F.inline(F.when(passes, F.array(F.struct(*outputs)))))


def clean_strict(
    landing: DataFrame,
    provinces: Provinces = fv.PROVINCES,
    column: str = fv.LANDING_COLUMN,
) -> DataFrame:
    """Records that pass every rule, flat, in the eight clean columns."""
    rows = parse_documents(landing, column, fv.CLEAN_FIELDS, variants=["age"])
    rows = mark_known_address(rows, provinces, F.col("address")).select(
        "*",
        whole_number(F.col("age")).alias("_age"),
        canonical_gender(F.col("gender")).alias("_gender"),
        strip(null_if_empty(F.col("address"))).alias("_address"),
    )
    age_is_missing = F.col("age").isNull() | is_json_null(F.col("age"))
    passes = (
        is_filled(F.col("_id"))
        & is_filled(F.col("name"))
        & is_filled(F.col("email"))
        & (~is_filled(F.col("gender")) | F.col("_gender").isNotNull())
        & (age_is_missing | is_valid_age(F.col("_age")))
        & (F.col("_address").isNull() | F.col(ADDRESS_KNOWN))
    )
    return emit(
        rows, passes,
        "_id", "name", "email", "phone",
        F.col("_gender").alias("gender"),
        F.col("_age").alias("age"),
        F.col("_address").alias("address"),
        with_default(F.col("occupation"), "").alias("occupation"),
    )


def clean_sentinel(
    landing: DataFrame,
    provinces: Provinces = fv.PROVINCES,
    column: str = fv.LANDING_COLUMN,
) -> DataFrame:
    """Records with markers for missing values; gender and address must be right.

    Absent and null differ here: an absent age is -1 while a null one drops the row,
    an absent occupation gets a marker while a null one stays null.
    """
    rows = parse_documents(landing, column, fv.CLEAN_FIELDS, variants=["age", "occupation"])
    rows = mark_known_address(rows, provinces, F.col("address")).select(
        "*",
        whole_number(F.col("age")).alias("_age"),
        gender_as_typed(F.col("gender")).alias("_gender"),
    )
    age, address, occupation = F.col("age"), F.col("address"), F.col("occupation")
    passes = (
        F.col("_gender").isNotNull()
        & (age.isNull() | is_valid_age(F.col("_age")))
        & (F.col(ADDRESS_KNOWN) | F.coalesce(address == fv.NOT_AVAILABLE, F.lit(False)))
    )
    return emit(
        rows, passes,
        with_default(F.col("_id"), fv.NO_ID_TEXT).alias("_id"),
        "name", "email", "phone",
        F.col("_gender").alias("gender"),
        F.when(age.isNull(), fv.MISSING_AGE).otherwise(F.col("_age")).alias("age"),
        strip(address).alias("address"),
        F.when(occupation.isNull(), fv.MISSING_WORD)
        .otherwise(variant_text(occupation)).alias("occupation"),
    )


TAG_VARIANTS = ("_id", "name", "phone", "age", "occupation")


def tag_rows(landing: DataFrame, provinces: Provinces, column: str) -> DataFrame:
    """Landing rows with the parsed `document`, its age and the address mark; no row is lost."""
    rows = try_parse_documents(landing, column, fv.CLEAN_FIELDS, TAG_VARIANTS)
    rows = rows.withColumn("_age", whole_number(F.col("document.age")))
    return mark_known_address(rows, provinces, F.col("document.address"))


def tagged_text() -> dict[str, Column]:
    """The eight tagged fields as text, from the columns of `tag_rows`.

    A text that is no JSON object gets markers everywhere but in `_id`, which is null.
    """
    def or_tag(field: str, null_text: str | None = None) -> Column:
        value = F.col(f"document.{field}")
        text = F.coalesce(variant_text(value), F.lit(null_text))
        return F.when(value.isNull(), fv.NOT_AVAILABLE).otherwise(text)

    address = with_default(F.col("document.address"), fv.NOT_AVAILABLE)
    age = valid_age(F.col("_age")).cast("string")
    return {
        "_id": F.when(F.col("document").isNotNull(), or_tag("_id", fv.NO_ID_TEXT)),
        "name": or_tag("name"),
        "email": valid_email_or_tag(F.col("document.email")),
        "phone": or_tag("phone"),
        "gender": gender_or_tag(F.col("document.gender")),
        "age": with_default(age, fv.NOT_AVAILABLE),
        "address": F.when(address == fv.NOT_AVAILABLE, fv.NOT_AVAILABLE)
        .when(F.col(ADDRESS_KNOWN), strip(address))
        .otherwise(fv.INVALID),
        "occupation": or_tag("occupation"),
    }


def tagged_record() -> Column:
    """The eight tagged fields as JSON text, with the JSON types the document had.

    A valid age is a number. The record of an unreadable text is all markers and
    carries the key `id` where others carry `_id`.
    """
    tag = F.lit(fv.NOT_AVAILABLE).cast("variant")
    typed = {f: F.coalesce(F.col(f"document.{f}"), tag) for f in ("name", "phone", "occupation")}
    typed["age"] = F.coalesce(valid_age(F.col("_age")).cast("variant"), tag)
    fields = {**tagged_text(), **typed}
    unreadable = {"id" if f == "_id" else f: F.lit(fv.NOT_AVAILABLE) for f in fv.CLEAN_FIELDS}
    return F.when(
        F.col("document").isNotNull(), F.to_json(F.struct(*[c.alias(f) for f, c in fields.items()]))
    ).otherwise(F.to_json(F.struct(*[c.alias(f) for f, c in unreadable.items()])))


def extra_record(column: str) -> Column:
    """Keys of the document beyond the eight, as JSON text."""
    entries = F.from_json(F.col(column), "map<string,variant>", JSON_OPTIONS)
    extra = F.map_filter(entries, lambda key, _: ~key.isin(*fv.CLEAN_FIELDS))
    return F.when(F.col("document").isNotNull(), F.to_json(extra))


def clean_tag(
    landing: DataFrame,
    provinces: Provinces = fv.PROVINCES,
    column: str = fv.LANDING_COLUMN,
) -> DataFrame:
    """All landing rows and columns plus `cleaned_data`, the tagged record as JSON text."""
    records = tag_rows(landing, provinces, column).select(
        *landing.columns, tagged_record().alias("_record"), extra_record(column).alias("_extra")
    )
    open_record = F.expr("left(_record, length(_record) - 1)")
    merged = F.concat(open_record, F.lit(","), F.substr("_extra", F.lit(2)))
    cleaned = F.when(F.length("_extra") > 2, merged).otherwise(F.col("_record"))
    return records.select(*landing.columns, cleaned.alias("cleaned_data"))


def tag_columns(
    landing: DataFrame,
    provinces: Provinces = fv.PROVINCES,
    column: str = fv.LANDING_COLUMN,
) -> DataFrame:
    """The tagged record of every landing row, flat, in the eight clean columns as text."""
    rows = tag_rows(landing, provinces, column)
    return rows.select(*[value.alias(field) for field, value in tagged_text().items()])


def clean_tag_flat(landing: DataFrame, provinces: Provinces = fv.PROVINCES) -> DataFrame:
    """The tagged records in the columns of the cleaned table; an age that is a marker is null."""
    rows = tag_columns(landing, provinces)
    return rows.withColumn("age", parse_int(F.col("age")))


PROFILES = {
    "strict": clean_strict, "sentinel": clean_sentinel, "tag": clean_tag, "tag_flat": clean_tag_flat,
}
