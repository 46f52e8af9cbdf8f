"""Users per segment: age group, region, occupation category, gender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmart.functions.lookups import occupation_category, province_region
from segmart.functions.text import age_bucket
from segmart.operators.keys import dense_keys
from segmart.operators.star import described

AGE, REGION, OCCUPATION, GENDER = "age", "region", "occupation_group", "gender"


def segment(counts: DataFrame, segment_type: str, description: str) -> DataFrame:
    """Rename a count per value to the common segment layout."""
    return counts.select(
        F.lit(segment_type).alias("segment_type"),
        F.col(description).alias("description"),
        "user_count",
    )


def count_by_dimension(
    fact: DataFrame, dimension: DataFrame, key: str, attribute: str, segment_type: str
) -> DataFrame:
    """Users per attribute of a dimension; facts without a member count under null.

    The fact is counted by its integer key first, so the join sees one row per
    member and not one per user.
    """
    per_member = fact.groupBy(key).agg(F.count("user_id").alias("n"))
    joined = per_member.join(dimension.select(key, attribute), key, "left")
    return segment(joined.groupBy(attribute).agg(F.sum("n").alias("user_count")), segment_type, attribute)


def insight_age(fact: DataFrame, dim_age_group: DataFrame) -> DataFrame:
    return count_by_dimension(fact, dim_age_group, "age_group_id", "description", AGE)


def insight_region(fact: DataFrame, dim_address: DataFrame) -> DataFrame:
    return count_by_dimension(fact, dim_address, "address_id", "region", REGION)


def insight_occupation(fact: DataFrame, dim_occupation: DataFrame) -> DataFrame:
    return count_by_dimension(fact, dim_occupation, "occupation_id", "category", OCCUPATION)


def insight_gender(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("gender").agg(F.count("user_id").alias("user_count"))
    return segment(counts, GENDER, "gender")


def union_segments(*insights: DataFrame) -> DataFrame:
    """All insights, one below the other."""
    result = insights[0]
    for other in insights[1:]:
        result = result.unionByName(other)
    return result


def with_ids(segments: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Add a dense id in the order of (segment_type, description) and the update time."""
    keyed = dense_keys(segments, ("segment_type", "description"), "id", id_type="bigint")
    return keyed.select(
        "id", "segment_type", "description", "user_count",
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
    )


def segment_insight_from_star(tables: dict[str, DataFrame], updated_at: Column | None = None) -> DataFrame:
    """The four insights of a written star. Each scan reads two narrow columns of the fact."""
    fact = tables["fct_user"]
    return with_ids(
        union_segments(
            insight_age(fact, tables["dim_age_group"]),
            insight_region(fact, tables["dim_address"]),
            insight_occupation(fact, tables["dim_occupation"]),
            insight_gender(fact),
        ),
        updated_at,
    )


def segment_insight(
    users: DataFrame,
    updated_at: Column | None = None,
    regions: DataFrame | None = None,
    categories: DataFrame | None = None,
) -> DataFrame:
    """The four insights straight from cleaned users, with ids and the update time."""
    return with_ids(segment_counts(users, regions, categories), updated_at)


def segment_counts(
    users: DataFrame, regions: DataFrame | None = None, categories: DataFrame | None = None
) -> DataFrame:
    """Users per segment straight from cleaned users, in one pass.

    The keys of the star lead from a value to a member and back, so the attributes
    are computed from the values and no dimension is joined. Users are first counted
    per combination of values; the few combinations are then described and summed up
    per attribute. `regions` and `categories` replace the built-in maps.
    """
    valued = users.where(F.col("_id").isNotNull()).select(
        age_bucket(F.col("age")).alias(AGE), "address", "occupation", F.col("gender").alias(GENDER)
    )
    combinations = valued.groupBy(AGE, "address", "occupation", GENDER).agg(F.count("*").alias("n"))
    address, occupation = F.col("address"), F.col("occupation")
    named = described(combinations, "address", REGION, province_region(address), regions)
    named = described(named, "occupation", OCCUPATION, occupation_category(occupation), categories)
    pairs = [
        F.struct(F.lit(AGE).alias("segment_type"), F.col(AGE).alias("description")),
        F.struct(F.lit(REGION).alias("segment_type"), F.when(address.isNotNull(), F.col(REGION)).alias("description")),
        F.struct(
            F.lit(OCCUPATION).alias("segment_type"),
            F.when(occupation.isNotNull(), F.col(OCCUPATION)).alias("description"),
        ),
        F.struct(F.lit(GENDER).alias("segment_type"), F.col(GENDER).alias("description")),
    ]
    return (
        named.select(F.inline(F.array(*pairs)), "n")
        .groupBy("segment_type", "description")
        .agg(F.sum("n").alias("user_count"))
    )
