"""Segment counts kept up to date: users per member of each dimension, changed by signed deltas.

Counts are kept per member (a key, or a gender) and not per segment. So a member that moves to
another segment takes its users with it, and no fact has to be read again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmart.operators import insight
from segmart.operators.insight import segment, union_segments

COUNTS_TABLE = "member_counts"

# Attribute of the fact, the dimension it leads to and the attribute that is counted.
MEMBERS = {
    "age_group_id": ("dim_age_group", "description", insight.AGE),
    "address_id": ("dim_address", "region", insight.REGION),
    "occupation_id": ("dim_occupation", "category", insight.OCCUPATION),
}


def signed_counts(fact: DataFrame, sign: int) -> DataFrame:
    """(attribute, member, n): users per member, all four attributes from one scan.

    Facts are counted per combination first, which combines on the map side.
    """
    columns = [*MEMBERS, "gender"]
    combined = fact.where("user_id IS NOT NULL").groupBy(*columns).agg(F.count("*").alias("_n"))
    pairs = F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("member")) for c in columns
    ])
    return combined.select(F.inline(pairs), (F.lit(sign) * F.col("_n")).alias("n"))


def summed(*counts: DataFrame) -> DataFrame:
    """Counts added up; members without users are left out."""
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("attribute", "member").agg(F.sum("n").alias("n")).where("n <> 0")


def segments_from_counts(counts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(segment_type, description, user_count) from the counts and the small dimensions."""
    found = []
    for key, (name, attribute, segment_type) in MEMBERS.items():
        dimension = tables[name].select(F.col(key).cast("string").alias("member"), attribute)
        per_member = counts.where(F.col("attribute") == key).drop("attribute")
        described = per_member.join(dimension, "member", "left")
        per_segment = described.groupBy(attribute).agg(F.sum("n").alias("user_count"))
        found.append(segment(per_segment, segment_type, attribute))
    genders = counts.where("attribute = 'gender'").select(
        F.col("member").alias("gender"), F.col("n").alias("user_count")
    )
    return union_segments(*found, segment(genders, insight.GENDER, "gender"))
