"""Lookups in fixed maps."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from segmart import fixed_values as fv


def map_lookup(key: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Value of `key` in a small fixed map, else `default` (also for a null key).

    Keys with the same value share one `isin`, which Spark turns into a hash-set
    test; a map literal would be searched key by key for every row.
    """
    groups = defaultdict(list)
    for member, value in mapping.items():
        groups[value].append(member)
    result = F.lit(default)
    for value, members in groups.items():
        result = F.when(key.isin(members), value).otherwise(result)
    return result


def province_region(province: Column) -> Column:
    return map_lookup(province, fv.PROVINCE_REGION, fv.OTHER)


def occupation_category(occupation: Column) -> Column:
    return map_lookup(occupation, fv.OCCUPATION_CATEGORY, fv.OTHER)
