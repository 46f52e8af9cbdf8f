"""Constraints of a batch against the star it goes into, checked over the keys it touches.

The star is valid before. A constraint can then only break where the batch has rows, so the
report is that of the full check over the merged star, at the cost of the batch: of the target
one narrow column of a table is scanned at most, and never shuffled for a small batch.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.operators.integrity import (
    FOREIGN_KEYS, PRIMARY_KEYS, REPORT_SCHEMA, fk_orphans, pk_violations, row_check_counts, with_int_keys,
)
from segmart.operators.joins import fits_broadcast
from segmart.operators.upsert import NATURAL_KEYS


class ConstraintError(ValueError):
    """A batch breaks constraints; `report` names them."""

    def __init__(self, report: list[dict]) -> None:
        super().__init__(f"the batch breaks constraints: {report}")
        self.report = report


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def repeated_after(target: DataFrame, batch: DataFrame, key: str, column: str) -> DataFrame:
    """(column, n_rows) of values that would occur more than once, of those the batch has.

    Rows of the target whose key the batch replaces count no more.
    """
    values = batch.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    held = target.select(key, column).join(_few(values.select(column)), column, "left_semi")
    stays = held.join(_few(batch.select(key)), key, "left_anti")
    more = stays.groupBy(column).agg(F.count("*").alias("n_rows"))
    both = values.unionByName(more).groupBy(column).agg(F.sum("n_rows").alias("n_rows"))
    return both.where("n_rows > 1")


def orphans_after(target: DataFrame, batch: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """(key, n_rows) of the batch's foreign keys with a parent neither in the batch nor in the target."""
    missing = fk_orphans(batch, key, parents, key)
    held = target.select(key).join(_few(missing.select(key)), key, "left_semi").distinct()
    return missing.join(held, key, "left_anti")


def batch_report(target: Mapping[str, DataFrame], batch: Mapping[str, DataFrame]) -> DataFrame:
    """(constraint, table, column, n_violations) as `star_report` has it, for a batch.

    `target` has INT keys, and the batch's are compared as INT. The ids of the batch's address,
    occupation and age dimensions are its own, so its facts need their members in the batch; a
    user may be in the target. A member that is repeated or null could not be given an id, and is
    reported as well.
    """
    typed = {name: with_int_keys(batch[name], fv.INTEGER_KEYS[name]) for name in PRIMARY_KEYS}

    def row(kind: str, table: str, column: str, found: DataFrame) -> DataFrame:
        counted = found.agg(F.count("*").alias("n"))
        return counted.select(*map(F.lit, (kind, table, column)), "n").toDF(*REPORT_SCHEMA)

    emails = repeated_after(target["dim_user"], typed["dim_user"], "user_id", "email")
    report = [row("unique", "dim_user", "email", emails)]
    for name, key in PRIMARY_KEYS.items():
        report.append(row("primary key", name, key, pk_violations(typed[name], key)))
        report.append(row_check_counts(name, batch[name]))
    for name, member in NATURAL_KEYS.items():
        report.append(row("unique", name, member, pk_violations(typed[name], member)))
    fact = typed["fct_user"]
    for key, name in FOREIGN_KEYS.items():
        if name == "dim_user":
            orphans = orphans_after(target[name], fact, typed[name], key)
        else:
            orphans = fk_orphans(fact, key, typed[name], key)
        report.append(row("foreign key", "fct_user", key, orphans))
    return reduce(DataFrame.unionByName, report)


def refuse_violations(report: DataFrame) -> None:
    """Raise `ConstraintError` if a report names violations."""
    failed = report.where("n_violations > 0").collect()  # one row per constraint at most
    if failed:
        raise ConstraintError([row.asDict() for row in failed])
