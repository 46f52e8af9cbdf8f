"""Versioned tables: all or nothing, copy on write by file, counts by deltas, checks of a batch."""

import re
import shutil

import pytest
from pyspark.sql import functions as F

from segmart.operators import counts, insight, upsert
from segmart.operators.delta_check import ConstraintError
from segmart.operators.integrity import star_report
from segmart.plans import jobs, versioned
from segmart.sources import versions
from segmart.sources.tables import STAR_TABLES, write_tables

USER = "user_id string, name string, email string"
FACT = "user_id string, occupation_id int, address_id int, age_group_id int, gender string"


def star_of(spark, users, facts, jobs=("Job",), places=(("An Giang", "South"),), ages=("18-30",)):
    """Star tables from tuples; ids of the small dimensions count from 1."""
    return {
        "dim_user": spark.createDataFrame(users, USER),
        "dim_occupation": spark.createDataFrame(
            [(i + 1, name, "Work") for i, name in enumerate(jobs)],
            "occupation_id int, occupation_name string, category string",
        ),
        "dim_address": spark.createDataFrame(
            [(i + 1, *place) for i, place in enumerate(places)], "address_id int, province string, region string"
        ),
        "dim_age_group": spark.createDataFrame(
            [(i + 1, age) for i, age in enumerate(ages)], "age_group_id int, description string"
        ),
        "fct_user": spark.createDataFrame(facts, FACT),
    }


def people(*numbers, name="n"):
    return [(str(i), f"{name}{i}", f"e{i}@x") for i in numbers]


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def recount(spark, root):
    tables = versions.read_version(spark, root, names=STAR_TABLES)
    fact = tables["fct_user"]
    return rows(insight.union_segments(
        insight.insight_age(fact, tables["dim_age_group"]), insight.insight_region(fact, tables["dim_address"]),
        insight.insight_occupation(fact, tables["dim_occupation"]), insight.insight_gender(fact),
    ))


@pytest.fixture(scope="module")
def first_version(spark, tmp_path_factory):
    """A version with 400 users in eight files each."""
    root = str(tmp_path_factory.mktemp("versions") / "root")
    facts = [(str(i), 1, 1, 1, "Male" if i % 2 else None) for i in range(400)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(versions, "ROWS_PER_FILE", 50)
        versioned.create_version(spark, root, star_of(spark, people(*range(400)), facts))
    return root


@pytest.fixture
def base(first_version, tmp_path):
    """A root of the test's own that holds that version."""
    return str(shutil.copytree(first_version, tmp_path / "root"))


def names_of(spark, root, table, number=None):
    version = versions.find_version(spark, root, number)
    return {f.file for f in versions.files_of(spark, root, version) if f.table == table}


def batch_of(spark):
    facts = [("3", 1, 2, 1, "Female"), ("4", 1, None, 2, "Male"), ("1000", 2, 1, 1, None)]
    return star_of(
        spark, people(3, 4, 1000, name="new"), facts, jobs=("Other job", "Job"),
        places=(("An Giang", "Moved"), ("Hà Nội", "North")), ages=("60+", "18-30"),
    )


def test_merge_equals_upsert_and_keeps_untouched_files(spark, base):
    batch = batch_of(spark)
    before = versions.read_version(spark, base, names=STAR_TABLES)
    wanted = upsert.upsert_star(before, batch)
    version = versioned.merge_version(spark, base, batch)
    after = versions.read_version(spark, base)
    assert version.number == 2
    for name in STAR_TABLES:
        assert rows(after[name]) == rows(wanted[name].select(*after[name].columns))
    old, new = names_of(spark, base, "fct_user", 1), names_of(spark, base, "fct_user")
    assert len(old) > 3 and len(old - new) == 1  # users 3 and 4 lie in one file
    assert rows(versions.read_version(spark, base, 1)["fct_user"]) == rows(before["fct_user"])


def test_only_keys_are_read_to_find_the_files(spark, base):
    table = versions.read_version(spark, base)["fct_user"]
    keys = F.broadcast(spark.createDataFrame([(3,), (4,)], "user_id int"))
    found = versioned.touched_files(table, keys, "user_id")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: struct<(.*?)>", plan) == ["user_id:int"]
    assert "SortMergeJoin" not in plan


def test_counts_follow_three_merges_without_untouched_facts(spark, base, monkeypatch):
    read = []
    signed = counts.signed_counts
    monkeypatch.setattr(
        counts, "signed_counts", lambda fact, sign: (
            read.append((sign, sum("/data/fct_user/" in f for f in fact.inputFiles()))), signed(fact, sign))[1]
    )
    third = star_of(spark, people(3), [("3", None, 1, 1, "Other")], places=(("Cà Mau", "South"),))
    for batch in (batch_of(spark), batch_of(spark), third):
        versioned.merge_version(spark, base, batch)
        assert rows(versioned.versioned_segments(spark, base)) == recount(spark, base)
    n_files = len(names_of(spark, base, "fct_user"))
    assert all(n <= 3 < n_files for sign, n in read if sign < 0)
    regions = versioned.versioned_segments(spark, base).where("segment_type = 'region'")
    assert {(r["description"], r["user_count"]) for r in regions.collect()} == {("Moved", 399), ("South", 1), (None, 1)}


def test_insight_has_ids_and_reads_no_fact(spark, base):
    got = versioned.versioned_insight(spark, base, updated_at=F.lit(None).cast("timestamp"))
    assert [r["id"] for r in got.orderBy("id").collect()] == [1, 2, 3, 4, 5]
    assert not any("/fct_user/" in f for f in versioned.versioned_segments(spark, base).inputFiles())


def test_a_faulty_batch_is_refused_with_its_report(spark, base, tmp_path):
    users = [*people(3, 5000), ("6", "x" * 300, "e7@x"), ("8", "twice", "d@x"), ("8", "again", "d@x"), ("x1", "no int", "f@x")]
    facts = [("3", 9, 1, 1, "Male"), ("7777", 1, 1, 1, "g" * 30), (None, 1, 1, 1, None), ("9", 1, 1, 1, "Male")]
    batch = star_of(spark, users, facts, jobs=("Job", "Job"))
    before = {name: rows(table) for name, table in versions.read_version(spark, base).items()}
    with pytest.raises(ConstraintError) as caught:
        versioned.merge_version(spark, base, batch)
    found = {(r["constraint"], r["table"], r["column"]): r["n_violations"] for r in caught.value.report}
    assert found == {
        ("unique", "dim_user", "email"): 2,  # of user 7, and twice in the batch
        ("primary key", "dim_user", "user_id"): 2,  # user 8, and the text that is no integer
        ("integer", "dim_user", "user_id"): 1, ("length", "dim_user", "name"): 1,
        ("unique", "dim_occupation", "occupation_name"): 1, ("primary key", "fct_user", "user_id"): 1,
        ("length", "fct_user", "gender"): 1, ("foreign key", "fct_user", "occupation_id"): 1,
        ("foreign key", "fct_user", "user_id"): 1,
    }
    assert versions.find_version(spark, base).number == 1
    assert {name: rows(table) for name, table in versions.read_version(spark, base).items()} == before
    with pytest.raises(ConstraintError):
        versioned.create_version(spark, str(tmp_path / "faulty"), batch)
    assert versions.find_version(spark, str(tmp_path / "faulty")) is None


def test_report_of_a_batch_is_that_of_the_merged_star(spark, base, tmp_path):
    """Two users with one e-mail, one of them only in the target, and a fact without a user."""
    users = [("5", "five", "e9@x"), ("401", "other", "e400@x"), ("402", "same", "e400@x")]
    batch = star_of(spark, users, [("5", 1, 1, 1, None), ("600", 1, 1, 1, None)])
    target = versions.read_version(spark, base, names=STAR_TABLES)
    merged, root = upsert.upsert_star(target, batch), str(tmp_path / "merged")
    write_tables(merged, root)
    full = star_report({n: spark.read.parquet(f"{root}/{n}") for n in STAR_TABLES}).where("n_violations > 0")
    with pytest.raises(ConstraintError) as caught:
        versioned.merge_version(spark, base, batch)
    assert sorted(map(repr, caught.value.report)) == sorted(repr(r.asDict()) for r in full.collect())


@pytest.mark.parametrize("at", [1, 3, 6])
def test_a_job_that_dies_between_tables_changes_nothing(spark, base, monkeypatch, at):
    before = {name: rows(table) for name, table in versions.read_version(spark, base).items()}
    write, calls = versions.write_files, []

    def dies(df, root, table):
        calls.append(table)
        if len(calls) == at:
            raise OSError("killed")
        return write(df, root, table)

    monkeypatch.setattr(versions, "write_files", dies)
    with pytest.raises(OSError):
        versioned.merge_version(spark, base, batch_of(spark))
    assert versions.find_version(spark, base).number == 1
    assert {name: rows(table) for name, table in versions.read_version(spark, base).items()} == before
    monkeypatch.setattr(versions, "write_files", write)
    assert versioned.merge_version(spark, base, batch_of(spark)).number == 2


def test_a_merge_into_a_folder_writes_nothing_for_a_faulty_batch(spark, tmp_path):
    target, staging, out = (str(tmp_path / name) for name in ("target", "staging", "out"))
    write_tables(star_of(spark, people(1, 2), [("1", 1, 1, 1, None), ("2", 1, 1, 1, None)]), target)
    write_tables(star_of(spark, [("3", "c", "e1@x")], [("3", 1, 1, 1, None)]), staging)
    with pytest.raises(ConstraintError, match="email"):
        jobs.merge_job(spark, target, staging, out)
    assert not (tmp_path / "out").exists()


def test_half_a_commit_is_none_and_the_second_writer_fails(spark, base):
    from pathlib import Path

    first = versions.find_version(spark, base)
    Path(base, "commits", "000000000002.json").write_text('{"version": 2, "manif')
    assert versions.find_version(spark, base) == first
    Path(base, "commits", "000000000002.json").unlink()
    files = versions.files_of(spark, base, first)
    schemas = {name: table.schema for name, table in versions.read_version(spark, base).items()}
    assert versions.commit(spark, base, files, schemas, first).number == 2
    with pytest.raises(versions.ConflictError):
        versions.commit(spark, base, files, schemas, first)
    with pytest.raises(versions.ConflictError):
        versioned.create_version(spark, base, {})


def test_empty_tables_and_missing_versions(spark, tmp_path):
    root = str(tmp_path / "root")
    with pytest.raises(ValueError, match="no version"):
        versions.read_version(spark, root)
    with pytest.raises(ValueError, match="no version"):
        versioned.merge_version(spark, root, {})
    empty = {name: table.limit(0) for name, table in star_of(spark, people(1), [("1", 1, 1, 1, None)]).items()}
    versioned.create_version(spark, root, empty)
    assert all(table.isEmpty() for table in versions.read_version(spark, root).values())
    versioned.merge_version(spark, root, batch_of(spark))
    versioned.merge_version(spark, root, empty)
    assert versions.find_version(spark, root).number == 3
    assert rows(versioned.versioned_segments(spark, root)) == recount(spark, root)
    with pytest.raises(ValueError, match="no version 9"):
        versions.read_version(spark, root, 9)
