"""Every query against its SQL twin, and the shapes of the plans that matter at scale."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from segmart.operators import insight
from segmart.plans import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "INTEGER": "int", "BOOLEAN": "boolean", "DATE": "date"}


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert catalog.QUERIES.keys() == oracle.ORACLE.keys()
    assert catalog.QUERIES.keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sql, sf_dir, name):
    got = entry_points.queries()[name](spark, sf_dir)
    wanted = sql.sql(entry_points.oracle_sql()[name])
    types = {c: SQL_TYPES[str(t)] for c, t in zip(wanted.columns, wanted.types)}
    assert dict(got.dtypes) == types
    columns = sorted(types)
    places = [wanted.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in places)) for row in wanted.fetchall())
    assert expected
    assert sorted(repr(tuple(row[c] for c in columns)) for row in got.collect()) == expected


def test_entry(spark):
    flagship = entry_points.entry(spark)
    assert flagship.columns == ["id", "segment_type", "description", "user_count"]
    assert flagship.count() == 20


# -- plans ------------------------------------------------------------------------------

def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name", ["clean_strict", "clean_sentinel", "clean_tag", "rule_gender", "doc_build", "synth_users", "length_violations"]
)
def test_row_wise_queries_do_not_shuffle(spark, sf_dir, name):
    plan = final_plan(catalog.QUERIES[name](spark, sf_dir))
    assert "Exchange" not in plan and "Python" not in plan


def test_dedupe_shuffles_once_and_combines_first(spark, sf_dir):
    plan = final_plan(catalog.dedupe_email(spark, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_min" in plan


def test_insight_scans_once(spark, sf_dir):
    plan = final_plan(insight.segment_counts(catalog.user_table(spark, sf_dir)))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    scanned = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "phone" not in scanned and "email" not in scanned


def test_fact_does_not_shuffle_users(spark, sf_dir):
    plan = final_plan(catalog.fct_user(spark, sf_dir))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 3


def test_orphans_are_counted_before_the_join(spark, sf_dir):
    plan = final_plan(catalog.fk_orphans(spark, sf_dir))
    assert plan.index("Join") < plan.index("partial_count")


def test_users_of_a_star_are_cleaned_by_all_cores(spark, sf_dir):
    from segmart.plans import fixture

    assert spark.read.parquet(f"{sf_dir}/customer.parquet").rdd.getNumPartitions() == 1
    spread = fixture.landing(spark, sf_dir, spread=True)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread.exceptAll(fixture.landing(spark, sf_dir)).isEmpty()
    assert spread.count() == fixture.landing(spark, sf_dir).count()
