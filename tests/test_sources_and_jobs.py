"""Files, tables, synthetic users and the end-to-end jobs."""

import json
from collections import Counter
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from segmart import __main__ as cli
from segmart import fixed_values as fv
from segmart.functions import documents as docs
from segmart.plans import fixture, jobs
from segmart.sources import jdbc, landing as landing_files, lists, synthetic, tables

AS_OF = date(2025, 7, 4)
DAY_1, DAY_2 = date(2025, 7, 1), date(2025, 7, 2)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# -- landing and CSV ---------------------------------------------------------------------

HARD_TEXTS = ['a,b', 'say "hi"', "line\nbreak", "back\\slash", "  spaces ", "Đặng", '","', "\r\n"]


def test_landing_round_trip_of_hard_texts(spark, tmp_path):
    path = str(tmp_path / "landing")
    texts = [json.dumps({"_id": str(i), "name": t}, ensure_ascii=False) for i, t in enumerate(HARD_TEXTS)]
    pretty = [json.dumps({"_id": "p", "name": "x"}, indent=2)]
    landing_files.write_landing(spark.createDataFrame([(t,) for t in texts + pretty], "d string"), path)
    back = landing_files.read_landing(spark, path)
    assert Counter(r[0] for r in back.collect()) == Counter(texts + pretty)
    parsed = docs.parse_documents(back, fv.LANDING_COLUMN, ["_id", "name"])
    assert {r._id: r.name for r in parsed.collect()} == {**{str(i): t for i, t in enumerate(HARD_TEXTS)}, "p": "x"}


def test_landing_with_other_columns_first(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('_ab_id,_airbyte_data,at\n1,"{""_id"":""7"",""name"":""A,B""}",2025\n', encoding="utf-8")
    rows = landing_files.read_landing(spark, str(path))
    assert [r._id for r in docs.parse_documents(rows, fv.LANDING_COLUMN, ["_id"]).collect()] == ["7"]
    with pytest.raises(ValueError):
        landing_files.read_landing(spark, str(path), column="other")


def test_single_line_landing_files_split(spark, tmp_path):
    path = str(tmp_path / "landing")
    documents = docs.to_documents(spark.createDataFrame([("1", "a\nb")], "id string, name string"))
    landing_files.write_landing(documents, path)
    row = landing_files.read_landing(spark, path, multi_line=False).first()
    assert json.loads(row[0]) == {"_id": "1", "name": "a\nb"}


def test_landing_files_have_bounded_rows(spark, tmp_path):
    path = str(tmp_path / "landing")
    landing_files.write_landing(spark.range(10).select(F.col("id").cast("string")).coalesce(1), path, rows_per_file=3)
    assert len(list((tmp_path / "landing").glob("*.csv"))) == 4


def test_files_that_one_task_reads_are_small_by_default(spark, tmp_path):
    rows = spark.range(250_000).coalesce(1)
    landing_files.write_landing(rows.select(F.col("id").cast("string")), str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").glob("*.csv"))) == 3
    users = rows.select(*[F.col("id").cast("string").alias(f) for f in fv.RAW_USER_FIELDS])
    landing_files.write_users_csv(users, str(tmp_path / "users"))
    assert len(list((tmp_path / "users").glob("*.csv"))) == 3
    assert landing_files.read_users_csv(spark, str(tmp_path / "users")).count() == 250_000


def test_users_csv_keeps_spaces(spark, tmp_path):
    path = str(tmp_path / "users")
    rows = [("1", *HARD_TEXTS)]
    users = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fv.RAW_USER_FIELDS))
    landing_files.write_users_csv(users, path)
    assert [tuple(r) for r in landing_files.read_users_csv(spark, path).collect()] == rows


def test_documents_leave_out_blank_fields(spark):
    users = spark.createDataFrame([("1", " ", "\t", None, " An Giang ")], "id string, name string, email string, phone string, address string")
    assert json.loads(docs.to_documents(users).first()[0]) == {"_id": "1", "address": " An Giang "}


def test_schema_of_a_whole_column(spark):
    rows = spark.createDataFrame([('{"age":null}',), ('{"age":3,"b":"x"}',), ("bad",)], "c string")
    assert docs.infer_schema(rows, "c").first()[0] == "OBJECT<age: BIGINT, b: STRING>"
    assert rows_of(docs.schema_census(rows, "c")) == {("age", "VOID", 1): 1, ("age", "BIGINT", 1): 1, ("b", "STRING", 1): 1}
    assert rows_of(docs.column_types(rows, "c")) == {("string",): 1}


# -- lists ------------------------------------------------------------------------------------

def test_city_list(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("city\nAn Giang\nBà Rịa - Vũng Tàu\n", encoding="utf-8")
    assert [r.city for r in lists.read_city_list(spark, str(path)).collect()] == ["An Giang", "Bà Rịa - Vũng Tàu"]
    missing = str(tmp_path / "none.csv")
    with pytest.raises(AnalysisException):
        lists.read_city_list(spark, missing).collect()
    assert lists.read_city_list(spark, missing, fallback=fv.FALLBACK_CITIES).count() == 3
    with pytest.raises(ValueError):
        lists.bounded_values(lists.city_list(spark), max_values=62)


def test_lookup_file(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps(fv.PROVINCE_REGION, ensure_ascii=False, indent=2), encoding="utf-8")
    assert {r.key: r.value for r in lists.read_lookup(spark, str(path)).collect()} == fv.PROVINCE_REGION
    assert rows_of(lists.lookup_table(spark, fv.PROVINCE_REGION)) == rows_of(lists.read_lookup(spark, str(path)))


# -- date partitions ------------------------------------------------------------------------------

def dated(spark, *rows):
    return spark.createDataFrame(
        [(i, "n", "e", None, None, 3, None, "", d) for i, d in rows], f"{fv.CLEAN_SCHEMA}, dt date"
    )


@pytest.mark.parametrize("overwrite, left", [("dynamic", {"1": DAY_1, "9": DAY_2}), ("static", {"9": DAY_2})])
def test_overwrite_of_one_date(spark, tmp_path, overwrite, left):
    root = str(tmp_path / "t")
    tables.write_by_date(dated(spark, ("1", DAY_1), ("2", DAY_2)), root, rebalance=True)
    tables.write_by_date(dated(spark, ("9", DAY_2)), root, overwrite)
    assert {r._id: r.dt for r in spark.read.parquet(root).collect()} == left


def test_run_date_scan(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_by_date(dated(spark, ("1", DAY_1), ("2", DAY_2)), root)
    scan = tables.read_run_date(spark, root, DAY_2)
    assert "dt" not in scan.columns and [r._id for r in scan.collect()] == ["2"]
    assert tables.read_run_date(spark, root, DAY_2, keep_date=True).first().dt == DAY_2
    with pytest.raises(AnalysisException):
        tables.read_run_date(spark, root, date(2024, 1, 1))
    some = tables.read_dates(spark, root, DAY_1, DAY_1)
    assert [r._id for r in some.collect()] == ["1"]
    assert "PartitionFilters: [isnotnull(dt" in some._jdf.queryExecution().executedPlan().toString()


def test_load_date(spark):
    assert tables.with_load_date(spark.range(1), DAY_1).first().dt == DAY_1
    assert tables.with_load_date(spark.range(1)).where("dt = current_date()").count() == 1


# -- synthetic users ----------------------------------------------------------------------------------

COUNTS = {
    "valid": 400, "bad_gender": 60, "bad_age": 60, "missing_fields": 60, "duplicate": 60,
    "multi_error": 200, "bad_register_date": 60,
}


@pytest.fixture(scope="module")
def synth(spark):
    return synthetic.synth_users(spark, COUNTS, AS_OF).cache()


def test_class_counts(synth):
    assert {r.error_class: r.n_rows for r in synthetic.error_class_counts(synth).collect()} == {**COUNTS, "total": 900}


def test_ids_follow_the_classes(synth):
    ids = synth.groupBy("error_class").agg(F.min(F.col("id").cast("int")).alias("a"), F.max(F.col("id").cast("int")).alias("b"))
    ranges, first = {}, 1
    for name in fv.ERROR_CLASSES:
        ranges[name] = (first, first + COUNTS[name] - 1)
        first += COUNTS[name]
    assert {r.error_class: (r.a, r.b) for r in ids.collect()} == ranges


def faults(row):
    return {
        "bad_gender": row.gender not in fv.GENDERS,
        "bad_age": not (row.age.isdigit() and int(row.age) <= 120),
        "missing_fields": row.address == "" or row.occupation == "",
        "bad_register_date": row.register_date in fv.BAD_REGISTER_DATES,
    }


def test_each_class_has_its_fault_only(synth):
    seen = Counter()
    for row in synth.collect():
        found = {name for name, present in faults(row).items() if present}
        if row.error_class in ("valid", "duplicate"):
            assert not found
        elif row.error_class == "multi_error":
            assert 2 <= len(found) <= 4
            seen[len(found)] += 1
        else:
            assert found == {row.error_class}
        assert row.email.endswith("@gmail.com") and " " not in row.email and row.email.isascii()
        assert len(row.phone) == 12 and row.phone[:2] in fv.PHONE_PREFIXES
    assert set(seen) == {2, 3, 4}


def test_faulty_values_all_occur(synth):
    rows = synth.collect()
    assert {r.gender for r in rows} == set(fv.GENDERS) | set(fv.BAD_GENDERS)
    assert {r.age for r in rows} > set(fv.BAD_AGES)
    assert {r.register_date for r in rows} > set(fv.BAD_REGISTER_DATES)
    assert {r.address for r in rows} <= set(fv.PROVINCES) | {""}


def test_duplicates_repeat_a_valid_email(synth):
    valid = {r.email for r in synth.where("error_class = 'valid'").collect()}
    assert all(r.email in valid for r in synth.where("error_class = 'duplicate'").collect())
    lone = synthetic.synth_users(synth.sparkSession, {"duplicate": 5}, AS_OF)
    assert lone.count() == 5 and lone.where("email IS NULL").isEmpty()


def test_middle_name_follows_gender(synth):
    allowed = {
        "Male": fv.MIDDLE_NAMES_MALE, "Female": fv.MIDDLE_NAMES_FEMALE,
        "Other": fv.MIDDLE_NAMES_MALE + fv.MIDDLE_NAMES_FEMALE,
    }
    for row in synth.where("error_class = 'valid'").collect():
        assert row.name.split()[1] in allowed[row.gender]


def test_unknown_class(spark):
    with pytest.raises(ValueError):
        synthetic.synth_users(spark, {"typo": 1}, AS_OF)


# -- jobs ------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def job_run(spark, tmp_path_factory, sf_dir):
    """CSV -> landing -> clean -> star over the customer users."""
    root = tmp_path_factory.mktemp("jobs")
    paths = {name: str(root / name) for name in ("csv", "landing", "clean", "star")}
    landing_files.write_users_csv(fixture.users_raw(spark, sf_dir), paths["csv"])
    jobs.load_job(spark, paths["csv"], paths["landing"])
    jobs.clean_job(spark, paths["landing"], paths["clean"], run_date=DAY_1)
    jobs.star_job(spark, paths["clean"], paths["star"], DAY_1)
    return paths


def test_job_results(spark, job_run):
    built = tables.read_tables(spark, job_run["star"], (*tables.STAR_TABLES, tables.INSIGHT_TABLE))
    assert {name: built[name].count() for name in tables.STAR_TABLES} == {
        "dim_user": 82, "dim_address": 8, "dim_occupation": 9, "dim_age_group": 6, "fct_user": 82,
    }
    insight = built[tables.INSIGHT_TABLE]
    counts = {(r.segment_type, r.description): r.user_count for r in insight.collect()}
    ages = ("Under 18", "18-30", "31-45", "46-60", "Over 60", "Unknown")
    assert [counts["age", a] for a in ages] == [18, 10, 17, 6, 26, 5]
    assert [counts["region", r] for r in ("Bắc", "Trung", "Nam", "Khác", None)] == [18, 18, 29, 8, 9]
    assert [counts["gender", g] for g in ("Male", "Female", "Other", None)] == [38, 28, 7, 9]
    categories = ("Y tế", "IT", "Nông nghiệp", "Kinh tế", "Khác")
    assert [counts["occupation_group", c] for c in categories] == [23, 8, 9, 9, 33]
    assert insight.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()[:] == (1, 20, 20)
    assert insight.where("updated_at IS NULL").isEmpty()
    per_type = insight.groupBy("segment_type").agg(F.sum("user_count").alias("n")).collect()
    assert {r.n for r in per_type} == {82}


def test_star_has_no_violations(spark, job_run):
    assert jobs.failed_constraints(spark, job_run["star"]).isEmpty()
    fact = jobs.publishable(spark, job_run["star"])["fct_user"]
    assert {t for _, t in fact.drop("gender").dtypes} == {"int"}


def test_known_ids_survive_a_second_run(spark, job_run, tmp_path):
    again = str(tmp_path / "star2")
    jobs.star_job(spark, job_run["clean"], again, DAY_1, known_root=job_run["star"])
    for name in ("dim_address", "dim_occupation", "dim_age_group", "fct_user"):
        assert rows_of(spark.read.parquet(f"{again}/{name}")) == rows_of(spark.read.parquet(f"{job_run['star']}/{name}"))
    with pytest.raises(ValueError):
        jobs.star_job(spark, job_run["clean"], again, DAY_1, known_root=again)


def test_merge_job_twice_is_once(spark, job_run, tmp_path):
    out = str(tmp_path / "merged")
    jobs.merge_job(spark, job_run["star"], job_run["star"], out)
    for name in tables.STAR_TABLES:
        assert rows_of(spark.read.parquet(f"{out}/{name}")) == rows_of(spark.read.parquet(f"{job_run['star']}/{name}"))
    with pytest.raises(ValueError):
        jobs.merge_job(spark, job_run["star"], out, out)


def test_load_appends_new_ids_only(spark, job_run, tmp_path, sf_dir):
    path, more = str(tmp_path / "landing"), str(tmp_path / "more")
    users = fixture.users_raw(spark, sf_dir)
    jobs.load_job(spark, job_run["csv"], path)
    new = users.where("id = '5'").withColumn("id", F.lit("new"))
    landing_files.write_users_csv(users.where("id < '2'").unionByName(new), more)
    jobs.load_job(spark, more, path, append=True)
    held = docs.parse_documents(landing_files.read_landing(spark, path), fv.LANDING_COLUMN, ["_id"])
    assert held.count() == 151 and held.where("_id = 'new'").count() == 1


def test_foreign_tables_stale_dates_and_further_columns(spark, job_run, tmp_path, sf_dir):
    root, star_root = str(tmp_path / "clean"), str(tmp_path / "star")
    jobs.clean_job(spark, job_run["landing"], root, "tag", DAY_1)
    with pytest.raises(ValueError, match="lack"):
        jobs.star_job(spark, root, star_root, DAY_1)
    jobs.clean_job(spark, job_run["landing"], root, "tag_flat", DAY_1)
    assert tables.read_run_date(spark, root, DAY_1).count() == 150
    row = ("An", "e", "p", "Male", 20, "An Giang", "Job")
    users = spark.createDataFrame([("1", *row), ("2", *row), ("2", "Bo", *row[1:])], fv.CLEAN_SCHEMA)
    tables.write_run_date(users, root, DAY_1)
    with pytest.raises(ValueError, match="several"):
        jobs.star_job(spark, root, star_root, DAY_1)
    built = jobs.star_job(spark, root, star_root, DAY_1, repeated="aside")
    assert [r.user_id for r in built["fct_user"].collect()] == ["1"]
    assert spark.read.parquet(f"{star_root}/users_aside").count() == 2
    csv, landing = str(tmp_path / "csv"), str(tmp_path / "landing")
    extra = fixture.users_raw(spark, sf_dir).where("id < '3'").withColumn("extra", F.lit("kept"))
    extra = extra.withColumn("id", F.when(F.col("id") == "1", "").otherwise(F.col("id")))
    extra.write.options(**landing_files.QUOTING).csv(csv)
    jobs.load_job(spark, csv, landing, multi_line=False)
    held = docs.parse_documents(landing_files.read_landing(spark, landing), fv.LANDING_COLUMN, ["_id", "extra"])
    assert held.where("extra = 'kept' AND _id IS NOT NULL").count() == extra.count()
    none = str(tmp_path / "none")
    landing_files.write_landing(spark.createDataFrame([("broken",)], "document string"), none)
    jobs.clean_job(spark, none, root, "strict", DAY_1)
    assert tables.read_run_date(spark, root, DAY_1).isEmpty()


@pytest.mark.parametrize("profile, n_rows", [("sentinel", 68), ("tag", 150)])
def test_other_profiles(spark, job_run, tmp_path, profile, n_rows):
    root = str(tmp_path / "clean")
    jobs.clean_job(spark, job_run["landing"], root, profile, DAY_1)
    written = spark.read.parquet(root)
    assert written.count() == n_rows
    assert ("cleaned_data" in written.columns) == (profile == "tag")


def test_command_line(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    cli.main(["generate", "--counts", "valid=50", "duplicate=10", "--cities", path("absent.csv"), "--as-of", "2025-07-04", "--out", path("csv")])
    cli.main(["load", "--users", path("csv"), "--landing", path("landing")])
    (tmp_path / "cities.csv").write_text("city\nHà Nội\nĐà Nẵng\nTP HCM\n", encoding="utf-8")
    cli.main(["clean", "--landing", path("landing"), "--clean", path("clean"), "--provinces", path("cities.csv"), "--run-date", "2025-07-04", "--single-line"])
    cli.main(["star", "--clean", path("clean"), "--star", path("star"), "--run-date", "2025-07-04"])
    cli.main(["check", "--star", path("star")])
    cli.main(["merge", "--target", path("star"), "--staging", path("star"), "--out", path("merged")])
    fact = spark.read.parquet(path("merged/fct_user"))
    assert 0 < fact.count() <= 50
    assert spark.read.parquet(path("star/dim_address")).count() <= 3


# -- JDBC: settings and order only, no database is started --------------------------------------------------

class FakeWriter:
    def __init__(self, log, table):
        self.log, self.settings = log, {"frame": table}

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **pairs):
        self.settings.update(pairs)
        return self

    def mode(self, mode):
        self.settings["mode"] = mode
        return self

    def save(self):
        self.log.append(self.settings)


class FakeTable:
    def __init__(self, log, name):
        self.write = FakeWriter(log, name)


def sent(publish):
    log = []
    target = jdbc.JdbcTarget("jdbc:x", {"user": "u", "driver": "d"}, connections=4)
    publish({name: FakeTable(log, name) for name in jdbc.LOAD_ORDER}, target)
    assert all(s["format"] == "jdbc" and s["url"] == "jdbc:x" and s["user"] == "u" for s in log)
    assert all(s["mode"] == "overwrite" and s["numPartitions"] == 4 and s["batchsize"] == 10_000 for s in log)
    return log


def test_overwrite_truncates_dimensions_before_the_fact():
    log = sent(jdbc.overwrite_star)
    assert [s["dbtable"] for s in log] == [
        "dim_user", "dim_address", "dim_occupation", "dim_age_group", "fct_user", "user_segment_insight",
    ]
    assert all(s["truncate"] for s in log)
    assert [s["cascadeTruncate"] for s in log] == [True] * 4 + [False] * 2


def test_staging_tables():
    log = sent(jdbc.stage_star)
    assert [s["dbtable"] for s in log] == [s["frame"] + "_staging" for s in log]
    assert not any("truncate" in s for s in log)


def test_publish_stops_at_violations(spark, job_run, tmp_path):
    broken = str(tmp_path / "star")
    built = tables.read_tables(spark, job_run["star"], (*tables.STAR_TABLES, tables.INSIGHT_TABLE))
    built["dim_address"] = built["dim_address"].limit(0)
    tables.write_tables(built, broken)
    with pytest.raises(ValueError, match="foreign key"):
        jobs.publish_job(spark, broken, jdbc.JdbcTarget("jdbc:none"))
