"""Rejected rows and their reasons, ids beside landing files, maps of one pair a line."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.operators import rejects, rules
from segmart.plans import jobs
from segmart.sources import landing as landing_files
from segmart.sources import lists, tables

GOOD = {"_id": "1", "name": "An", "email": "a@x", "age": 20, "gender": "boy", "address": " An Giang "}


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture
def faulty(landing):
    return landing(
        GOOD, None, "not json", "[1]", '{"_id": "2"} tail', {"name": "", "email": None, "_id": "3"},
        {**GOOD, "_id": "4", "gender": "??", "age": "abc", "address": "Atlantis"}, {**GOOD, "_id": "5", "age": None},
        {**GOOD, "_id": "6", "age": 121}, {**GOOD, "_id": "7", "age": True, "gender": "", "address": "  "}, {},
    )


def test_kept_and_rejected_are_all_that_landed(spark, faulty, tmp_path):
    root = str(tmp_path / "ledger")
    rejects.write_ledger(rejects.ledger(faulty), root)
    kept, rejected = rejects.read_kept(spark, root), rejects.read_rejected(spark, root)
    assert kept.count() + rejected.count() == faulty.count()
    assert rows(kept) == rows(rules.clean_strict(faulty))
    found = {r[fv.LANDING_COLUMN]: r["reasons"] for r in rejected.collect()}
    assert found[None] == found["not json"] == found["[1]"] == ["unreadable"]
    assert found["{}"] == ["_id", "name", "email"]
    by_id = {r["_id"]: r["reasons"] for r in rejected.where("_id IS NOT NULL").collect()}
    assert by_id["3"] == ["name", "email"] and by_id["4"] == ["gender", "age", "address"] and by_id["6"] == ["age"]
    assert {r["fail_bits"] for r in rejected.where("_id = '4'").collect()} == {16 + 32 + 64}


def test_one_parse_feeds_both_sinks(faulty):
    plan = rejects.ledger(faulty)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "Exchange" not in plan and "Python" not in plan


def test_provinces_from_a_table_and_names_of_the_input(spark, faulty):
    places = spark.createDataFrame([("Atlantis",)], "city string")
    wanted = {r["_id"]: r["fail_bits"] for r in rejects.ledger(faulty, ["Atlantis"]).collect()}
    got = rejects.ledger(faulty.withColumns({"document": F.lit(1), "source": F.lit(2)}), places)
    assert {r["_id"]: r["fail_bits"] for r in got.collect()} == wanted
    assert wanted["1"] == 64 and wanted["4"] == 16 + 32
    assert rejects.ledger(faulty.limit(0)).collect() == []


def test_clean_job_with_rejects(spark, faulty, tmp_path):
    path, clean, plain, aside = (str(tmp_path / n) for n in ("landing", "clean", "plain", "aside"))
    day = date(2025, 7, 4)
    landing_files.write_landing(faulty, path)
    jobs.clean_job(spark, path, clean, run_date=day, rejects_root=aside)
    jobs.clean_job(spark, path, plain, run_date=day)
    assert rows(tables.read_run_date(spark, clean, day)) == rows(tables.read_run_date(spark, plain, day))
    found = spark.read.parquet(f"{aside}/dt=2025-07-04")
    assert found.where("fail_bits = 112").count() == 1 and found.where(F.col("source").contains("part-")).count() == found.count()
    with pytest.raises(ValueError, match="strict"):
        jobs.clean_job(spark, path, clean, profile="tag", run_date=day, rejects_root=aside)


def test_append_parses_only_new_files(spark, landing, tmp_path):
    path = str(tmp_path / "landing")
    landing_files.write_landing(landing({"_id": "1"}, {"_id": "2"}, {"name": "no id"}).coalesce(1), path)
    assert landing_files.index_landing(spark, path).count() == 1
    assert landing_files.index_landing(spark, path).count() == 0
    landing_files.write_landing(landing({"name": "no id in this file"}).coalesce(1), path, mode="append")
    landing_files.write_landing(landing({"_id": "7"}).coalesce(1), path, mode="append")  # by someone else
    assert landing_files.index_landing(spark, path).count() == 2
    assert {r["id"] for r in landing_files.landed_ids(spark, path).collect()} == {"1", "2", "7", None}
    assert landing_files.read_landing(spark, path).count() == 5  # the table of ids is not read as landing rows


def test_maps_of_one_pair_a_line(spark, tmp_path, monkeypatch):
    pairs = spark.createDataFrame([("a", "1"), ("b \"q\"\n", "ü"), ("c", None)], "key string, value string")
    path = str(tmp_path / "map.jsonl")
    lists.write_lookup_lines(pairs.repartition(3), path)
    assert rows(lists.read_lookup_lines(spark, path)) == rows(pairs)
    one = tmp_path / "map.json"
    one.write_text('{"a": "1", "b": "2"}')
    assert rows(lists.read_lookup(spark, str(one))) == rows(spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string"))
    monkeypatch.setattr(lists, "MAX_OBJECT_BYTES", 10)
    with pytest.raises(ValueError, match="one pair per line"):
        lists.read_lookup(spark, str(one))
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"key": "a", "value": "1"}\nno json\n')
    with pytest.raises(Exception):
        lists.read_lookup_lines(spark, str(bad)).collect()
