"""Publishing to a relational target over JDBC. URL and properties are the caller's."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from segmart.sources.tables import INSIGHT_TABLE

DIMENSIONS = ("dim_user", "dim_address", "dim_occupation", "dim_age_group")
FACT = "fct_user"
LOAD_ORDER = (*DIMENSIONS, FACT, INSIGHT_TABLE)
STAGING_SUFFIX = "_staging"


@dataclass(frozen=True)
class JdbcTarget:
    """Connection and write settings of a relational target.

    `connections` bounds the parallel connections of one table, `batch_rows` the
    rows per insert round trip.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16
    batch_rows: int = 10_000

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", **options: object) -> None:
        writer = df.write.format("jdbc").options(**self.properties)
        writer = writer.option("url", self.url).option("dbtable", table)
        writer = writer.option("numPartitions", self.connections)
        writer = writer.option("batchsize", self.batch_rows)
        for name, value in options.items():
            writer = writer.option(name, value)
        writer.mode(mode).save()


def overwrite_star(tables: Mapping[str, DataFrame], target: JdbcTarget) -> None:
    """Replace the rows of the star tables and keep the tables' constraints.

    Tables are truncated, never dropped. Truncating a dimension cascades to the fact
    that refers to it, so the dimensions are loaded first and the fact after them.
    """
    for name in LOAD_ORDER:
        if name in tables:
            cascade = name in DIMENSIONS
            target.write(tables[name], name, truncate=True, cascadeTruncate=cascade)


def stage_star(tables: Mapping[str, DataFrame], target: JdbcTarget) -> None:
    """Write each table to its staging table, from which the database can upsert."""
    for name in LOAD_ORDER:
        if name in tables:
            target.write(tables[name], name + STAGING_SUFFIX)
