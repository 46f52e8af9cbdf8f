"""The star as versioned tables: created once, then merged batch after batch, all or nothing.

A merge checks the batch first, rewrites only files that hold a key of it, changes the stored
counts by what was replaced and added, and becomes visible with one commit file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.operators import counts
from segmart.operators.delta_check import batch_report, refuse_violations
from segmart.operators.insight import with_ids
from segmart.operators.integrity import star_report, with_int_keys
from segmart.operators.joins import fits_broadcast
from segmart.operators.upsert import STAR_KEYS, rekeyed
from segmart.session import at_once, staged
from segmart.sources import versions
from segmart.sources.tables import STAR_TABLES


def _int_star(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: with_int_keys(star[name], fv.INTEGER_KEYS.get(name, ())) for name in STAR_TABLES}


def _write(table: DataFrame, root: str, name: str) -> list[versions.DataFile]:
    """New files of a table in the order of its key, so that a later batch meets few of them."""
    key = STAR_KEYS.get(name)
    rows = table.repartitionByRange(key).sortWithinPartitions(key) if key else table
    return versions.write_files(rows, root, name)


def create_version(spark: SparkSession, root: str, star: Mapping[str, DataFrame]) -> versions.Version:
    """The first version, from star tables that are files; refused if they break a constraint."""
    if versions.find_version(spark, root) is not None:
        raise versions.ConflictError(f"{root} holds a version already")
    refuse_violations(star_report(star))
    tables = _int_star(star)
    tables[counts.COUNTS_TABLE] = counts.summed(counts.signed_counts(tables["fct_user"], 1))
    written = at_once(spark, {name: partial(_write, table, root, name) for name, table in tables.items()})
    schemas = {name: table.schema for name, table in tables.items()}
    return versions.commit(spark, root, [f for files in written.values() for f in files], schemas, None)


def touched_files(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(file,) of files with a row whose key is among the batch's; of the table only the key is read."""
    located = table.select(key, F.col("_metadata.file_name").alias("file"))
    return located.join(keys, key, "left_semi").select("file").distinct()


class TableMerge:
    """One table of a merge: the files that hold keys of the batch, and the others.

    The batch has unique keys. One of a checked small size is broadcast, and then the target's
    rows stay where they are.
    """

    def __init__(
        self, spark: SparkSession, root: str, base: versions.Version, files: Sequence[versions.DataFile],
        name: str, batch: DataFrame,
    ) -> None:
        self.root, self.name, self.key, self.batch = root, name, STAR_KEYS[name], batch
        keys = batch.select(self.key)
        self.keys = F.broadcast(keys) if fits_broadcast(keys) else keys
        own = [file for file in files if file.table == name]
        touched: set[str] = set()
        if own:
            table = versions.read_files(spark, root, base, name, own)
            touched = {row["file"] for row in touched_files(table, self.keys, self.key).collect()}
        self.carried = [file for file in own if file.file not in touched]
        self.old = versions.read_files(spark, root, base, name, [f for f in own if f.file in touched])

    def replaced(self) -> DataFrame:
        """The rows that the batch replaces."""
        return self.old.join(self.keys, self.key, "left_semi")

    def write(self) -> list[versions.DataFile]:
        """The table's files after the merge: untouched ones, and one set of new ones for the rest."""
        columns = self.old.columns
        stays = self.old.join(self.keys, self.key, "left_anti").select(*columns)
        return self.carried + _write(stays.unionByName(self.batch.select(*columns)), self.root, self.name)


def _cast_as(batch: DataFrame, table: DataFrame) -> DataFrame:
    return batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])


def merge_version(spark: SparkSession, root: str, staging: Mapping[str, DataFrame]) -> versions.Version:
    """Upsert a star, built apart, into the latest version; the result is the next version.

    A batch that would break a constraint raises `ConstraintError` with the report, before
    anything is written below `root`. A job that ends before the commit leaves the latest version
    as it was. Files without a key of the batch are neither rewritten nor read beyond their key.
    """
    base = versions.find_version(spark, root)
    if base is None:
        raise ValueError(f"{root} holds no version")
    files = versions.files_of(spark, root, base)
    target = {name: versions.read_files(spark, root, base, name, files) for name in STAR_TABLES}
    raw = at_once(spark, {name: partial(staged, staging[name], "batch") for name in STAR_TABLES})
    refuse_violations(batch_report(target, raw))
    keyed = rekeyed(target, _int_star(raw))
    typed = {name: _cast_as(keyed[name], target[name]) for name in STAR_TABLES}
    batch = at_once(spark, {name: partial(staged, table, "batch") for name, table in typed.items()})

    merges = at_once(spark, {
        name: partial(TableMerge, spark, root, base, files, name, batch[name]) for name in STAR_TABLES
    })
    fact = merges["fct_user"]
    old_counts = versions.read_files(spark, root, base, counts.COUNTS_TABLE, files)
    new_counts = counts.summed(
        old_counts, counts.signed_counts(fact.replaced(), -1), counts.signed_counts(fact.batch, 1)
    )
    steps = {name: merge.write for name, merge in merges.items()}
    steps[counts.COUNTS_TABLE] = partial(versions.write_files, new_counts, root, counts.COUNTS_TABLE)
    written = [file for found in at_once(spark, steps).values() for file in found]
    schemas = {name: table.schema for name, table in target.items()} | {counts.COUNTS_TABLE: old_counts.schema}
    return versions.commit(spark, root, written, schemas, base)


def versioned_insight(
    spark: SparkSession, root: str, number: int | None = None, updated_at: Column | None = None
) -> DataFrame:
    """The segment insight of a version from its stored counts; no fact is read."""
    return with_ids(versioned_segments(spark, root, number), updated_at)


def versioned_segments(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """(segment_type, description, user_count) of a version from its stored counts."""
    names = (counts.COUNTS_TABLE, "dim_address", "dim_occupation", "dim_age_group")
    tables = versions.read_version(spark, root, number, names)
    return counts.segments_from_counts(tables[counts.COUNTS_TABLE], tables)
