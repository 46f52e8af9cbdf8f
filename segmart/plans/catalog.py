"""Every operator as a query over the given tables."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions import documents as docs
from segmart.functions import lookups, text
from segmart.operators import dedupe, insight, integrity, keys, rejects, rules, star
from segmart.operators.delta_check import batch_report
from segmart.operators.upsert import upsert, upsert_star
from segmart.plans import fixture, jobs, versioned
from segmart.plans.fixture import landing, table, users_raw
from segmart.session import at_once, scratch_path, staged
from segmart.sources import landing as landing_files
from segmart.sources import lists, synthetic, tables, versions

AS_OF = date(2025, 7, 4)
FIRST_DATE = date(2025, 7, 1)
SHARES = {
    "valid": 68, "bad_gender": 6, "bad_age": 6, "missing_fields": 6, "duplicate": 6,
    "multi_error": 6, "bad_register_date": 2,
}


# -- inputs shared by several queries --------------------------------------------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing rows parsed, nothing cleaned."""
    return docs.parse_documents(landing(spark, sf_dir), fv.LANDING_COLUMN, fv.CLEAN_FIELDS)


def strict_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.cleaned(landing(spark, sf_dir), "strict")


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned users as a written table, as the star job reads them."""
    return staged(jobs.cleaned(landing(spark, sf_dir, spread=True), "strict"), "users")


def dated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned users spread over three dates."""
    day = (F.col("_id").try_cast("bigint") % 3).cast("int")
    return strict_users(spark, sf_dir).withColumn("dt", F.date_add(F.lit(FIRST_DATE), day))


# -- scalars -----------------------------------------------------------------------

def email_slug(spark, sf_dir):
    name = F.concat_ws("  ", "name", "address", "occupation")
    return users_raw(spark, sf_dir).select("id", text.email_slug(name).alias("slug"))


def phone_format(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "_id", text.phone_format(F.col("phone")).alias("phone")
    )


def register_date_format(spark, sf_dir):
    days = (F.col("c_custkey") % (fv.REGISTER_DATE_SPAN_DAYS + 1)).cast("int")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.register_date(AS_OF, days).alias("register_date")
    )


def age_bucket(spark, sf_dir):
    age = text.parse_int(F.col("age"))
    return users_raw(spark, sf_dir).select(
        "id", age.alias("age"), text.age_bucket(age).alias("age_group")
    )


def user_id_cast(spark, sf_dir):
    large = F.col("id").cast("bigint") % 5 == 0
    source = F.when(large, F.concat("id", F.lit("0000000000"))).otherwise(F.col("id"))
    return users_raw(spark, sf_dir).select(
        source.alias("source_id"), integrity.to_int_key(source).alias("user_id")
    )


def province_region(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "_id", "address", lookups.province_region(text.strip(F.col("address"))).alias("region")
    )


def occupation_category(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "_id", "occupation", lookups.occupation_category(F.col("occupation")).alias("category")
    )


# -- sources and documents ------------------------------------------------------------

def synth_users(spark, sf_dir):
    return synthetic.inject_errors(table(spark, sf_dir, "customer"), "c_custkey", SHARES, AS_OF)


def error_class_counts(spark, sf_dir):
    return synthetic.error_class_counts(synth_users(spark, sf_dir))


def doc_build(spark, sf_dir):
    return docs.to_documents(users_raw(spark, sf_dir))


def landing_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "landing")
    landing_files.write_landing(landing(spark, sf_dir), path)
    fields = ["_id", *fv.RAW_USER_FIELDS[1:]]
    return docs.parse_documents(landing_files.read_landing(spark, path), fv.LANDING_COLUMN, fields)


def users_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "users-csv")
    landing_files.write_users_csv(users_raw(spark, sf_dir), path)
    return landing_files.read_users_csv(spark, path)


def damaged_props(spark, sf_dir):
    """Event properties, most of them damaged in one of six ways."""
    props, kind = F.col("props"), F.col("event_id") % 7
    damaged = (
        F.when(kind == 1, F.substr(props, F.lit(2)))
        .when(kind == 2, F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == 3, F.concat(props, F.lit(" xyz")))
        .when(kind == 4, F.lit(None).cast("string"))
        .when(kind == 5, F.concat(props, props))
        .when(kind == 6, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .otherwise(props)
    )
    return table(spark, sf_dir, "events").select("event_id", damaged.alias("body"))


def json_parse_guard(spark, sf_dir):
    rows = docs.try_parse_documents(damaged_props(spark, sf_dir), "body", ["k"])
    return rows.select("event_id", F.col("document").isNotNull().alias("is_object"), "document.k")


def record_to_json(spark, sf_dir):
    users = strict_users(spark, sf_dir)
    record = docs.record_to_json(*users.columns, keep_nulls=True)
    return users.select("_id", record.alias("record"))


def schema_census(spark, sf_dir):
    return docs.schema_census(landing(spark, sf_dir), fv.LANDING_COLUMN)


def schema_infer(spark, sf_dir):
    return docs.infer_schema(table(spark, sf_dir, "events"), "props")


def typeof_distinct(spark, sf_dir):
    return docs.column_types(table(spark, sf_dir, "events"), "props")


def lookup_explode(spark, sf_dir):
    return lists.lookup_entries(table(spark, sf_dir, "events"), "props", "event_id")


# -- rules and profiles -----------------------------------------------------------------

def rule_required(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "_id",
        rules.is_filled(F.col("_id")).alias("has_id"),
        rules.is_filled(F.col("name")).alias("has_name"),
        rules.is_filled(F.col("email")).alias("has_email"),
    )


def rule_email_format(spark, sf_dir):
    email = rules.valid_email_or_tag(F.col("email"))
    return documents(spark, sf_dir).select("_id", email.alias("email"))


def rule_optional_defaults(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "_id",
        rules.with_default(F.col("phone"), fv.NOT_AVAILABLE).alias("phone"),
        rules.with_default(F.col("occupation"), "").alias("occupation_strict"),
        rules.with_default(F.col("occupation"), fv.MISSING_WORD).alias("occupation_sentinel"),
    )


def rule_gender(spark, sf_dir):
    gender = F.col("gender")
    return documents(spark, sf_dir).select(
        "_id",
        rules.is_known_gender(gender).alias("is_known"),
        rules.canonical_gender(gender).alias("canonical"),
        rules.gender_as_typed(gender).alias("as_typed"),
        rules.gender_or_tag(gender).alias("tagged"),
    )


def rule_age(spark, sf_dir):
    rows = docs.parse_documents(
        landing(spark, sf_dir), fv.LANDING_COLUMN, ["_id", "age"], variants=["age"]
    )
    return rows.select(
        "_id",
        docs.variant_text(F.col("age")).alias("age_text"),
        rules.whole_number(F.col("age")).alias("number"),
    ).select("_id", "age_text", rules.valid_age(F.col("number")).alias("age"))


def rule_address(spark, sf_dir):
    address = F.col("address")
    return documents(spark, sf_dir).select(
        "_id", text.strip(address).alias("address"), rules.is_province(address).alias("is_known")
    )


def clean_strict(spark, sf_dir):
    return rules.clean_strict(landing(spark, sf_dir))


def clean_sentinel(spark, sf_dir):
    return rules.clean_sentinel(landing(spark, sf_dir))


def clean_tag(spark, sf_dir):
    return rules.tag_columns(landing(spark, sf_dir))


def clean_tag_json(spark, sf_dir):
    return rules.clean_tag(landing(spark, sf_dir)).select("cleaned_data")


def clean_rejects(spark, sf_dir):
    """The rows that the strict profile rejects, from the table beside the kept ones."""
    root = scratch_path(spark, "ledger")
    rejects.write_ledger(rejects.ledger(landing(spark, sf_dir)), root)
    found = rejects.read_rejected(spark, root)
    return found.select("_id", "fail_bits", F.array_join("reasons", ",").alias("reasons"))


def load_append(spark, sf_dir):
    """Ids landed by two loads, the second of which brings half of the first one's ids again."""
    users, root = users_raw(spark, sf_dir), scratch_path(spark, "append")
    number = F.col("id").cast("bigint")
    parts = users.where(number % 3 != 0), users.where(number % 2 == 0)
    for i, part in enumerate(parts):
        landing_files.write_users_csv(part.withColumn("name", F.concat("name", F.lit(f" of load {i + 1}"))), f"{root}/csv{i}")
        jobs.load_job(spark, f"{root}/csv{i}", f"{root}/landing", append=i > 0)
    landed = landing_files.read_landing(spark, f"{root}/landing")
    return docs.parse_documents(landed, fv.LANDING_COLUMN, ["_id", "name"])


def valid_province_join(spark, sf_dir):
    rows = users_raw(spark, sf_dir).select("id", "address")
    return rules.valid_province_rows(rows, lists.city_list(spark))


# -- de-duplication and keys --------------------------------------------------------------

def dedupe_email(spark, sf_dir):
    return strict_users(spark, sf_dir)


def dedupe_email_sentinel(spark, sf_dir):
    return jobs.cleaned(landing(spark, sf_dir), "sentinel")


def insert_ignore(spark, sf_dir):
    """Users as the collection, line items as the batch: known order numbers are rejected."""
    users = users_raw(spark, sf_dir).select("id", "name", "phone")
    batch = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_returnflag").alias("name"),
        F.col("l_linestatus").alias("phone"),
    )
    return dedupe.insert_ignore(users, batch, "id")


def emails(spark, sf_dir):
    return star.members(documents(spark, sf_dir), "email", "email")


def surrogate_keys(spark, sf_dir):
    return keys.dense_keys(emails(spark, sf_dir), "email", "email_id")


def surrogate_keys_incremental(spark, sf_dir):
    """Addresses of cleaned users keep their ids, the other addresses come after them."""
    cleaned = star.members(strict_users(spark, sf_dir), "email", "email")
    known = keys.dense_keys(cleaned, "email", "email_id")
    return keys.extend_keys(known, emails(spark, sf_dir), "email", "email_id")


# -- star and insight -------------------------------------------------------------------------

def dim_user(spark, sf_dir):
    return star.dim_user(strict_users(spark, sf_dir))


def dim_address(spark, sf_dir):
    return star.dim_address(strict_users(spark, sf_dir))


def dim_address_wide(spark, sf_dir):
    """Addresses from a column of many values, with their regions."""
    users = table(spark, sf_dir, "part").select(F.col("p_name").alias("address"))
    return star.dim_address(users)


def region_map(spark, sf_dir):
    """A map of the parts' names to their brands, written to files of one pair a line and read back."""
    pairs = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("key")).agg(F.min("p_brand").alias("value"))
    path = scratch_path(spark, "regions")
    lists.write_lookup_lines(pairs, path)
    return lists.read_lookup_lines(spark, path)


def province_region_table(spark, sf_dir):
    """Regions from a map that is read from a file."""
    users = table(spark, sf_dir, "part").select(F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, "?").otherwise("")).alias("address"))
    return star.dim_address(users, regions=region_map(spark, sf_dir))


def star_from_tag(spark, sf_dir):
    """Tagged rows written flat, read back by date and counted per segment."""
    root = scratch_path(spark, "tagged")
    tables.write_run_date(jobs.cleaned(landing(spark, sf_dir), "tag_flat"), root, FIRST_DATE)
    users = tables.read_run_date(spark, root, FIRST_DATE)
    return insight.segment_insight(users).drop("updated_at")


def stars_of(spark: SparkSession, *users: DataFrame) -> list[dict[str, DataFrame]]:
    """A star of each set of users, built apart."""
    steps = {i: partial(jobs.build_star, spark, part, scratch_path(spark, "star")) for i, part in enumerate(users)}
    return list(at_once(spark, steps).values())


def merge_star(spark, sf_dir):
    """Stars of the users with even and with odd ids, built apart, merged and flattened."""
    users = user_table(spark, sf_dir)
    odd = F.col("_id").try_cast("bigint") % 2 == 1
    halves = stars_of(spark, users.where(odd), users.where(~odd))
    natural = ("province", "region", "occupation_name", "category", "description")
    return star.flat_star(upsert_star(*halves)).select("user_id", "name", "email", "gender", *natural)


def merged_versions(spark, sf_dir) -> str:
    """Root of a versioned star: a third of the users with other attributes, then three merges.

    The first merge replaces all of that third, the others add new users and members.
    """
    users, root = user_table(spark, sf_dir), scratch_path(spark, "versions")
    thirds = [users.where(F.col("_id").try_cast("bigint") % 3 == n) for n in range(3)]
    before = thirds[0].withColumns({"gender": F.lit("Other"), "address": F.lit("An Giang"), "name": F.lit("before")})
    first, *batches = stars_of(spark, before, *thirds)
    versioned.create_version(spark, root, first)
    for batch in batches:
        versioned.merge_version(spark, root, batch)
    return root


def merge_star_versions(spark, sf_dir):
    """The latest version after three merges, flattened."""
    flat = star.flat_star(versions.read_version(spark, merged_versions(spark, sf_dir)))
    natural = ("province", "region", "occupation_name", "category", "description")
    return flat.select(F.col("user_id").cast("string"), "name", "email", "gender", *natural)


def insight_delta(spark, sf_dir):
    """The insight of the latest version from counts that three merges kept up to date."""
    return versioned.versioned_insight(spark, merged_versions(spark, sf_dir)).drop("updated_at")


def batch_check(spark, sf_dir):
    """The constraint report of a faulty batch against the star of the other half of the users.

    The batch takes e-mails of that half, has names above the limit, and facts of unknown users.
    """
    users = user_table(spark, sf_dir)
    odd = F.col("_id").try_cast("bigint") % 2 == 1
    target, batch = stars_of(spark, users.where(odd), users.where(~odd))
    number = F.col("user_id").cast("bigint")
    people, facts = batch["dim_user"], batch["fct_user"]
    people = people.withColumn(
        "email", F.when(number % 5 == 0, F.concat(F.lit("user"), (number + 1).cast("string"), F.lit("@example.com")))
        .otherwise(F.col("email"))
    ).withColumn("name", F.when(number % 7 == 0, F.repeat(F.lit("n"), 256)).otherwise(F.col("name")))
    unknown = facts.where(number % 11 == 0).withColumn("user_id", (number + 1_000_000_000).cast("string"))
    batch |= {"dim_user": people, "fct_user": facts.unionByName(unknown)}
    typed = {name: integrity.with_int_keys(t, fv.INTEGER_KEYS.get(name, ())) for name, t in target.items()}
    report = batch_report(typed, {name: staged(t, "batch") for name, t in batch.items()})
    return report.where("n_violations > 0")


def dim_occupation(spark, sf_dir):
    return star.dim_occupation(strict_users(spark, sf_dir))


def dim_age_group(spark, sf_dir):
    return star.dim_age_group(strict_users(spark, sf_dir))


def fct_user(spark, sf_dir):
    users = user_table(spark, sf_dir)
    dimensions = star.dim_address(users), star.dim_occupation(users), star.dim_age_group(users)
    return star.fact_rows(users, *[staged(d, "dimension") for d in dimensions])


def insight_age(spark, sf_dir):
    users = user_table(spark, sf_dir)
    dimension = staged(star.dim_age_group(users), "dimension")
    return insight.insight_age(star.fact_rows(users, age_group=dimension), dimension)


def insight_region(spark, sf_dir):
    users = user_table(spark, sf_dir)
    dimension = staged(star.dim_address(users), "dimension")
    return insight.insight_region(star.fact_rows(users, address=dimension), dimension)


def insight_occupation(spark, sf_dir):
    users = user_table(spark, sf_dir)
    dimension = staged(star.dim_occupation(users), "dimension")
    return insight.insight_occupation(star.fact_rows(users, occupation=dimension), dimension)


def insight_gender(spark, sf_dir):
    return insight.insight_gender(star.fact_rows(user_table(spark, sf_dir)))


def segment_insight(spark, sf_dir):
    return insight.segment_insight(user_table(spark, sf_dir)).drop("updated_at")


def segment_insight_star(spark, sf_dir):
    """The same counts from a written star: four insights, one below the other."""
    built = jobs.staged_star(spark, strict_users(spark, sf_dir), scratch_path(spark, "star"))
    return insight.segment_insight_from_star(built).drop("updated_at")


# -- tables ------------------------------------------------------------------------------------

def partition_scan(spark, sf_dir):
    root = scratch_path(spark, "dated")
    tables.write_by_date(dated_users(spark, sf_dir), root, rebalance=True)
    return tables.read_run_date(spark, root, FIRST_DATE, keep_date=True)


def partition_overwrite(spark, sf_dir):
    """Three dates written, then one of them again with changed rows: the others stay."""
    root = scratch_path(spark, "dated")
    users = dated_users(spark, sf_dir)
    tables.write_by_date(users, root, rebalance=True)
    second = users.where(F.col("dt") == F.lit(date(2025, 7, 2)))
    tables.write_by_date(second.withColumn("phone", F.lit("rewritten")), root)
    return spark.read.schema(f"{fv.CLEAN_SCHEMA}, dt date").parquet(root)


def star_roundtrip(spark, sf_dir):
    """The five star tables written, read back and joined."""
    built = jobs.staged_star(spark, strict_users(spark, sf_dir), scratch_path(spark, "star"))
    return star.flat_star(built)


# -- upsert and integrity -----------------------------------------------------------------------

def upsert_dim(spark, sf_dir):
    """Cleaned users upserted with one row per user of the events."""
    users = star.dim_user(strict_users(spark, sf_dir))
    seen = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    staging = seen.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("seen in events: "), "n").alias("name"),
        F.concat(F.lit("seen"), "user_id", F.lit("@example.com")).alias("email"),
    )
    return upsert(users, staging, "user_id")


def upsert_fact(spark, sf_dir):
    """The fact of strictly cleaned users upserted with that of leniently cleaned ones."""
    strict = user_table(spark, sf_dir)
    sentinel = staged(dedupe_email_sentinel(spark, sf_dir), "users")
    group = staged(star.dim_age_group(strict.unionByName(sentinel)), "age-groups")
    target = star.fact_rows(strict, age_group=group)
    return upsert(target, star.fact_rows(sentinel, age_group=group), "user_id")


def pk_violations(spark, sf_dir):
    return integrity.pk_violations(table(spark, sf_dir, "lineitem"), "l_orderkey")


def unique_violations(spark, sf_dir):
    return integrity.unique_violations(documents(spark, sf_dir), "email")


def fk_orphans(spark, sf_dir):
    """Orders whose customer did not pass the strict profile."""
    users = strict_users(spark, sf_dir).select(F.col("_id").try_cast("bigint").alias("user_id"))
    return integrity.fk_orphans(table(spark, sf_dir, "orders"), "o_custkey", users, "user_id")


def length_violations(spark, sf_dir):
    limits = {"p_name": 9, "p_type": 7}
    return integrity.length_violations(table(spark, sf_dir, "part"), "p_partkey", limits)


QUERIES = {
    query.__name__: query
    for query in (
        email_slug, phone_format, register_date_format, age_bucket, user_id_cast,
        province_region, occupation_category,
        synth_users, error_class_counts, doc_build, landing_roundtrip, users_csv_roundtrip,
        json_parse_guard, record_to_json, schema_census, schema_infer, typeof_distinct,
        lookup_explode,
        rule_required, rule_email_format, rule_optional_defaults, rule_gender, rule_age,
        rule_address, clean_strict, clean_sentinel, clean_tag, clean_tag_json, clean_rejects,
        valid_province_join,
        dedupe_email, dedupe_email_sentinel, insert_ignore, load_append, surrogate_keys,
        surrogate_keys_incremental,
        dim_user, dim_address, dim_address_wide, province_region_table, dim_occupation, dim_age_group, fct_user,
        insight_age, insight_region, insight_occupation, insight_gender, segment_insight,
        segment_insight_star,
        star_from_tag, partition_scan, partition_overwrite, star_roundtrip, merge_star,
        merge_star_versions, insight_delta, batch_check,
        upsert_dim, upsert_fact, pk_violations, unique_violations, fk_orphans,
        length_violations,
    )
}
