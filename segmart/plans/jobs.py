"""The end-to-end jobs: load, clean, build the star, publish."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions.documents import to_documents
from segmart.functions.text import null_if_blank
from segmart.operators import rejects, star
from segmart.operators.dedupe import accepted_rows, dedupe_email
from segmart.operators.delta_check import batch_report, refuse_violations
from segmart.operators.insight import segment_insight_from_star
from segmart.operators.integrity import star_report, with_int_keys
from segmart.operators.joins import lookup_join
from segmart.operators.rules import PROFILES, Provinces
from segmart.operators.upsert import upsert_star
from segmart.session import scratch_path, staged
from segmart.sources import jdbc, tables
from segmart.sources.landing import index_landing, landed_ids, read_landing, read_users_csv, write_landing

# Profiles whose records are unique per e-mail afterwards; the tag profile keeps every row.
DEDUPED_PROFILES = ("strict", "sentinel")


def load_job(
    spark: SparkSession,
    users_csv: str,
    landing_path: str,
    append: bool = False,
    multi_line: bool = True,
) -> None:
    """User CSV files to landing files of JSON documents, each user id at most once.

    A row without an id gets a unique one, as a document store would give it. With
    `append`, ids that the landing files already hold are left out: they come from the table
    of ids beside the files, and only files that it does not know are parsed. Files without
    line breaks inside values are split over tasks with `multi_line=False`.
    """
    users = read_users_csv(spark, users_csv, multi_line)
    users = users.withColumn("id", F.coalesce(null_if_blank(F.col("id")), F.expr("uuid()")))
    if append:
        index_landing(spark, landing_path, multi_line=multi_line)
        held = landed_ids(spark, landing_path).select("id")
    else:
        held = spark.createDataFrame([], "id string")
    once = accepted_rows(held, users, key="id")
    write_landing(to_documents(once), landing_path, mode="append" if append else "overwrite")
    index_landing(spark, landing_path, multi_line=multi_line)


def cleaned(
    landing: DataFrame, profile: str = "strict", provinces: Provinces = fv.PROVINCES
) -> DataFrame:
    """Landing rows through one cleaning profile, one row per e-mail where the profile asks."""
    records = PROFILES[profile](landing, provinces)
    return dedupe_email(records) if profile in DEDUPED_PROFILES else records


def clean_job(
    spark: SparkSession,
    landing_path: str,
    clean_root: str,
    profile: str = "strict",
    run_date: date | None = None,
    provinces: Provinces = fv.PROVINCES,
    overwrite: str = "dynamic",
    multi_line: bool = True,
    rejects_root: str | None = None,
) -> None:
    """Landing files to the cleaned table's partition of the run date.

    With `rejects_root` the rows that the strict profile rejects go to that folder's partition of
    the date, with their file and the rules they break; the documents are parsed once for both.
    """
    landing = read_landing(spark, landing_path, multi_line=multi_line)
    if rejects_root is None:
        records = cleaned(landing, profile, provinces)
    elif profile != "strict":
        raise ValueError("only the strict profile has a table of rejected rows")
    else:
        split = scratch_path(spark, "ledger")
        source = F.col("_metadata.file_path")
        rejects.write_ledger(rejects.ledger(landing, provinces, source=source), split)
        records = dedupe_email(rejects.read_kept(spark, split))
        tables.write_run_date(rejects.read_rejected(spark, split), rejects_root, run_date or date.today())
    if overwrite == "dynamic":
        tables.write_run_date(records, clean_root, run_date or date.today())
    else:
        tables.write_by_date(tables.with_load_date(records, run_date), clean_root, overwrite)


def build_star(
    spark: SparkSession,
    users: DataFrame,
    star_root: str,
    known_root: str | None = None,
    regions: DataFrame | None = None,
    categories: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write the five star tables and read them back.

    `users` should be a table, since several jobs scan it. Dimensions are written
    before the fact, so the fact joins files whose size is cheap to measure. With
    `known_root`, the star of an earlier run, its members keep their ids. `regions` and
    `categories` are (key, value) tables in place of the built-in maps.
    """
    if known_root is not None and known_root.rstrip("/") == star_root.rstrip("/"):
        raise ValueError("the known star is still being read: give another output root")
    known = {}
    if known_root is not None:
        known = tables.read_tables(spark, known_root, ("dim_address", "dim_occupation", "dim_age_group"))
    dimensions = {
        "dim_user": star.dim_user(users),
        "dim_address": star.dim_address(users, known.get("dim_address"), regions),
        "dim_occupation": star.dim_occupation(users, known.get("dim_occupation"), categories),
        "dim_age_group": star.dim_age_group(users, known.get("dim_age_group")),
    }
    tables.write_tables(dimensions, star_root)
    built = tables.read_tables(spark, star_root, tuple(dimensions))
    rows = star.fact_rows(
        users, built["dim_address"], built["dim_occupation"], built["dim_age_group"]
    )
    tables.write_tables({"fct_user": rows}, star_root)
    return tables.read_tables(spark, star_root)


def star_job(
    spark: SparkSession,
    clean_root: str,
    star_root: str,
    run_date: date | None = None,
    known_root: str | None = None,
    regions: DataFrame | None = None,
    categories: DataFrame | None = None,
    repeated: str = "stop",
) -> dict[str, DataFrame]:
    """One date of the cleaned table to the star tables and the segment insight.

    Ids with several (name, e-mail) pairs break the target's primary key. With
    `repeated="stop"` they end the job before anything is written; with "aside" all
    their rows go to the folder `users_aside` and the star is built from the others.
    """
    users = tables.read_run_date(spark, clean_root, run_date)
    several = staged(star.repeated_ids(users), "repeated")
    if not several.isEmpty():
        if repeated != "aside":
            found = [row["_id"] for row in several.take(5)]
            raise ValueError(f"ids with several names or e-mails, such as {found}")
        aside = lookup_join(users, several, "_id", "left_semi")
        tables.write_tables({"users_aside": aside.select(*users.columns)}, star_root)
        users = staged(lookup_join(users, several, "_id", "left_anti").select(*users.columns), "users")
    built = build_star(spark, users, star_root, known_root, regions, categories)
    insight = segment_insight_from_star(built)
    tables.write_tables({tables.INSIGHT_TABLE: insight}, star_root)
    return tables.read_tables(spark, star_root, (*tables.STAR_TABLES, tables.INSIGHT_TABLE))


def publishable(spark: SparkSession, star_root: str) -> dict[str, DataFrame]:
    """The written tables with keys as INT, as the relational schema declares them."""
    names = (*tables.STAR_TABLES, tables.INSIGHT_TABLE)
    found = tables.read_tables(spark, star_root, names)
    return {
        name: with_int_keys(table, fv.INTEGER_KEYS.get(name, ())) for name, table in found.items()
    }


def failed_constraints(spark: SparkSession, star_root: str) -> DataFrame:
    """Rows of the constraint report with violations, on the keys as they were written."""
    found = tables.read_tables(spark, star_root)
    return star_report(found).where("n_violations > 0")


def publish_job(
    spark: SparkSession, star_root: str, target: jdbc.JdbcTarget, mode: str = "overwrite"
) -> None:
    """Written tables to a relational target; nothing is sent when a constraint fails.

    `mode` is overwrite, or staging for a database that upserts from staging tables.
    """
    failed = failed_constraints(spark, star_root).collect()  # one row per constraint at most
    if failed:
        raise ValueError(f"constraints violated: {[row.asDict() for row in failed]}")
    publish = {"overwrite": jdbc.overwrite_star, "staging": jdbc.stage_star}[mode]
    publish(publishable(spark, star_root), target)


def merge_job(spark: SparkSession, target_root: str, staging_root: str, out_root: str) -> None:
    """Upsert the star at `staging_root` into the star at `target_root`, written to `out_root`.

    The staging star is checked against the target first: if it breaks a constraint, the job
    ends with `ConstraintError` and `out_root` stays as it is. Readers who must never see some
    tables of the old star beside some of the new one need `versioned.merge_version`.
    """
    if out_root.rstrip("/") in (target_root.rstrip("/"), staging_root.rstrip("/")):
        raise ValueError("both inputs are still being read: give another output root")
    target, staging = (tables.read_tables(spark, root) for root in (target_root, staging_root))
    typed = {name: with_int_keys(table, fv.INTEGER_KEYS.get(name, ())) for name, table in target.items()}
    refuse_violations(batch_report(typed, staging))
    tables.write_tables(upsert_star(target, staging), out_root)


def staged_star(spark: SparkSession, users: DataFrame, star_root: str) -> dict[str, DataFrame]:
    """The star of users that are not a table yet."""
    return build_star(spark, staged(users, "users"), star_root)
