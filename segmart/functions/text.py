"""Text, number and date expressions. All of them stay inside generated code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from segmart import fixed_values as fv

INTEGER_TEXT = r"^([+-]?[0-9]+(?:_[0-9]+)*)$"
ID_DIGITS = r"^([0-9]{1,19})$"
EMAIL_START = r"^[^@]+@[^@]+\.[^@]+"
WHITE_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends (`trim` alone removes only spaces)."""
    return F.btrim(text, F.lit(fv.WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for text of white space only, null for null."""
    return strip(text) == ""


def null_if_blank(text: Column) -> Column:
    """The unchanged text, or null where it is blank."""
    return F.when(~is_blank(text), text)


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def parse_int(text: Column) -> Column:
    """Whole number from text, null where the text is not one.

    Accepts surrounding white space, a sign and single underscores between digits;
    rejects fractions and exponents.
    """
    return F.translate(matched(strip(text), INTEGER_TEXT), "_", "").try_cast("int")


def numeric_id(text: Column) -> Column:
    """Number of an all-digit id, null for any other text."""
    return matched(text, ID_DIGITS).try_cast("bigint")


def matched(text: Column, pattern: str) -> Column:
    """First group of the pattern, null without a match.

    Used in front of `try_cast`, which raises and catches an error for each text it
    cannot read and so is slow on dirty columns.
    """
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def looks_like_email(text: Column) -> Column:
    """Something, an at sign, something with a dot inside. Only the start must match."""
    return text.rlike(EMAIL_START)


def fold_letters(text: Column) -> Column:
    """Replace accented Vietnamese lower-case letters by their base letter."""
    accented = "".join(fv.FOLDED_LETTERS.values())
    base = "".join(letter * len(group) for letter, group in fv.FOLDED_LETTERS.items())
    return F.translate(text, accented, base)


def email_slug(name: Column) -> Column:
    """Mail address made from a name: lower case, folded, dots for white space."""
    local_part = F.regexp_replace(fold_letters(F.lower(name)), WHITE_SPACE_RUN, ".")
    return F.concat(local_part, F.lit(fv.EMAIL_DOMAIN))


def phone_format(digits: Column) -> Column:
    """`0912345678` -> `0912 345 678`; null for null."""
    gap = F.lit(" ")
    return F.concat(
        F.substring(digits, 1, 4), gap, F.substring(digits, 5, 3), gap, F.substr(digits, F.lit(8))
    )


def register_date(as_of: date | Column, days_back: Column) -> Column:
    """Date `days_back` days before `as_of`, as dd/MM/yyyy text."""
    base = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.date_format(F.date_sub(base, days_back), fv.REGISTER_DATE_FORMAT)


def age_bucket(age: Column) -> Column:
    """Age-group label. Zero and negative ages fall into the second group."""
    return (
        F.when(age.isNull(), fv.NO_AGE)
        .when((age > 0) & (age < 18), fv.UNDER_18)
        .when(age <= 30, fv.FROM_18)
        .when(age <= 45, fv.FROM_31)
        .when(age <= 60, fv.FROM_46)
        .otherwise(fv.OVER_60)
    )


AGE_GROUP_SQL = f"""
CREATE OR REPLACE TEMPORARY FUNCTION age_group(age INT) RETURNS STRING
RETURN CASE
    WHEN age IS NULL THEN '{fv.NO_AGE}'
    WHEN age > 0 AND age < 18 THEN '{fv.UNDER_18}'
    WHEN age <= 30 THEN '{fv.FROM_18}'
    WHEN age <= 45 THEN '{fv.FROM_31}'
    WHEN age <= 60 THEN '{fv.FROM_46}'
    ELSE '{fv.OVER_60}' END
"""


def register_sql_functions(spark) -> None:
    """Offer `age_group(age)` to SQL text; it is inlined, so no Python runs."""
    spark.sql(AGE_GROUP_SQL)
