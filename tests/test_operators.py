"""De-duplication, keys, joins, star, insight, upsert and integrity on small fixtures."""

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.operators import dedupe, insight, integrity, joins, keys, star
from segmart.operators.upsert import DuplicateKeyError, upsert, upsert_parquet, upsert_star
from segmart.session import staged

USER_SCHEMA = fv.CLEAN_SCHEMA


def user(_id, email, name="An", gender="Male", age=30, address="Gia Lai", occupation="Y tá"):
    return (_id, name, email, "0912", gender, age, address, occupation)


def users_of(spark, *rows):
    return spark.createDataFrame(list(rows), USER_SCHEMA)


def as_set(df, *columns):
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


# -- de-duplication -------------------------------------------------------------------

def test_dedupe_keeps_lowest_number(spark):
    rows = users_of(
        spark, user("10", "a"), user("9", "a"), user("x", "a"), user("x", "b"), user("y", "b"),
        user("2", None), user("1", None), user("07", "c"), user("7", "c"),
    )
    assert as_set(dedupe.dedupe_email(rows), "_id", "email") == {
        ("9", "a"), ("x", "b"), ("1", None), ("07", "c"),
    }


@pytest.mark.parametrize("partitions", [1, 7])
def test_dedupe_of_same_id_is_fixed(spark, partitions):
    rows = users_of(spark, *[user("1", "a", name=f"n{i}", age=i) for i in range(20, 60)])
    kept = dedupe.dedupe_email(rows.repartition(partitions)).collect()
    assert [(r.name, r.age) for r in kept] == [("n20", 20)]


def test_dedupe_with_a_third_of_rows_on_one_key(spark):
    rows = spark.range(30_000).select(
        F.col("id").cast("string").alias("_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), "id")).alias("email"),
    )
    kept = dedupe.lowest_per_key(rows, "email", "_id")
    assert kept.count() == 20_001
    assert kept.where("email = 'hot'").collect() == [("0", "hot")]


def test_insert_ignore(spark):
    target = spark.createDataFrame([("1", "old"), ("2", "old")], "_id string, name string")
    batch = spark.createDataFrame(
        [("2", "new"), ("3", "b"), ("3", "a"), (None, "x"), (None, "x")], "_id string, name string"
    )
    result = Counter(tuple(r) for r in dedupe.insert_ignore(target, batch).collect())
    assert result == {("1", "old"): 1, ("2", "old"): 1, ("3", "a"): 1, (None, "x"): 2}
    keys_only = dedupe.insert_ignore(target.select("_id"), batch.select("_id"))
    assert Counter(r[0] for r in keys_only.collect()) == {"1": 1, "2": 1, "3": 1, None: 2}


# -- keys ---------------------------------------------------------------------------------

@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("partitions", ["3", "16"])
def test_dense_keys_depend_on_members_alone(spark, adaptive, partitions):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        names = [f"m{(i * 7919) % 1000:04d}" for i in range(1000)]
        members = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
        got = {r.name: r.id for r in keys.dense_keys(members, "name", "id").collect()}
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert got == {name: i for i, name in enumerate(sorted(names), 1)}


def test_dense_keys_keep_other_columns_and_types(spark):
    members = spark.createDataFrame([("b", 1.5), ("a", 2.5)], "name string, x double")
    keyed = keys.dense_keys(members, "name", "id", after=10)
    assert keyed.dtypes == [("id", "int"), ("name", "string"), ("x", "double")]
    assert as_set(keyed) == {(11, "a", 2.5), (12, "b", 1.5)}


def test_ids_beyond_int_fail(spark):
    members = spark.createDataFrame([("a",), ("b",)], "name string")
    assert keys.dense_keys(members, "name", "id", after=2**31 - 3).count() == 2
    with pytest.raises(PySparkException):
        keys.dense_keys(members, "name", "id", after=2**31 - 2).collect()
    assert keys.dense_keys(members, "name", "id", after=2**31, id_type="bigint").count() == 2


def test_extend_keys(spark):
    known = spark.createDataFrame([(1, "b"), (5, "gone")], "id int, name string")
    members = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    extended = keys.extend_keys(known, members, "name", "id")
    assert as_set(extended) == {(1, "b"), (5, "gone"), (6, "a"), (7, "c")}
    none_known = keys.extend_keys(known.limit(0), members, "name", "id")
    assert as_set(none_known) == {(1, "a"), (2, "b"), (3, "c")}


# -- joins ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth on null, the rest spread."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    rows = spark.range(6_000).select("id", key.alias("key"))
    names = spark.range(0, 500, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    lookup = names.unionByName(spark.createDataFrame([("hot",), ("unused",)], "key string"))
    return rows, lookup.withColumn("value", F.concat(F.lit("v-"), "key"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("lookup_size", ["small", "large", "empty"])
def test_lookup_join(spark, skewed, how, lookup_size, monkeypatch):
    rows, lookup = skewed
    if lookup_size == "empty":
        lookup = lookup.where("key = 'nothing'")
    if lookup_size == "large":
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    got = joins.lookup_join(rows, lookup, "key", how)
    assert got.count() > 0 or (lookup_size == "empty" and how in ("inner", "left_semi"))
    wanted = rows.join(lookup, "key", how)
    assert got.select(*wanted.columns).exceptAll(wanted).isEmpty()
    assert wanted.exceptAll(got.select(*wanted.columns)).isEmpty()


def test_hot_keys_are_few(skewed):
    rows, _ = skewed
    assert [r.key for r in joins.hot_keys(rows, "key", share=10).collect()] == ["hot"]
    assert joins.hot_keys(rows, "key", share=2).isEmpty()


def test_measured_size(spark, monkeypatch):
    df = spark.createDataFrame([("ab", 1), ("ấ", 2), (None, 3)], "s string, n int")
    assert joins.measured_size(df) == (3, 2 + 3 + 3 * 8)
    assert joins.measured_size(df.limit(0)) == (0, 0)
    assert joins.fits_broadcast(df)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 28)
    assert not joins.fits_broadcast(df)
    monkeypatch.undo()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    assert not joins.fits_broadcast(df)


def test_unmatched_keeps_null_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    other = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert as_set(joins.unmatched(rows, other, "key")) == {("b",), (None,)}


# -- star and insight ---------------------------------------------------------------------------

def star_of(users):
    built = {
        "dim_user": star.dim_user(users),
        "dim_address": star.dim_address(users),
        "dim_occupation": star.dim_occupation(users),
        "dim_age_group": star.dim_age_group(users),
    }
    rows = star.fact_rows(
        users, built["dim_address"], built["dim_occupation"], built["dim_age_group"]
    )
    return {**built, "fct_user": rows}


def test_star(spark):
    users = users_of(
        spark,
        user("1", "a", age=10, address="Hà Nội", occupation=""),
        user("2", "b", age=None, address=None, occupation="Bác sĩ", gender=None),
        user("3", "c", age=70, address="An Giang", occupation=None),
    )
    built = star_of(users)
    assert as_set(built["dim_user"]) == {("1", "An", "a"), ("2", "An", "b"), ("3", "An", "c")}
    assert as_set(built["dim_address"]) == {(1, "An Giang", "Nam"), (2, "Hà Nội", "Khác")}
    assert as_set(built["dim_occupation"]) == {(1, "", "Khác"), (2, "Bác sĩ", "Y tế")}
    assert as_set(built["dim_age_group"]) == {(1, "Over 60"), (2, "Under 18"), (3, "Unknown")}
    assert as_set(built["fct_user"]) == {
        ("1", 1, 2, 2, "Male"), ("2", 2, None, 3, None), ("3", None, 1, 1, "Male"),
    }


def test_repeated_ids_are_named_and_multiply_nothing(spark):
    users = users_of(
        spark,
        user("1", "a", age=10), user("1", "b", age=40), user("1", "c", age=41, gender=None),
        user("2", "d"), user(None, "e"), *[user("hot", f"h{i}") for i in range(300)],
    )
    assert {r["_id"] for r in star.repeated_ids(users).collect()} == {"1", "hot"}
    built = star_of(users)
    assert built["fct_user"].count() == 304 and star.flat_star(built).count() == 304
    per_age = Counter(r.description for r in built["fct_user"].join(built["dim_age_group"], "age_group_id").collect())
    assert per_age["Under 18"] == 1 and per_age["31-45"] == 2
    assert rows_without_time(insight.segment_insight(users)) == rows_without_time(insight.segment_insight_from_star(built))


def test_star_beyond_every_broadcast_limit(spark, monkeypatch):
    """All lookups, the upsert keys and the province list take the way of large tables."""
    users = users_of(
        spark,
        *[user(str(i // 2), f"e{i}", age=i % 90, occupation=f"job {i % 7}") for i in range(60)],
        *[user("hot", f"h{i}", address=None, occupation="") for i in range(30)],
        user(None, "none"),
    )
    small = star_of(users)
    small_insight = rows_without_time(insight.segment_insight(users))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    large = star_of(users)
    assert small["fct_user"].count() == 60 + 30
    for name in small:
        assert Counter(large[name].collect()) == Counter(small[name].collect())
    assert rows_without_time(insight.segment_insight(users)) == small_insight
    target, staging = users.select("email", "age"), users.where("age > 40").select("email", F.lit(1).alias("age"))
    merged = Counter(upsert(target, staging, "email").collect())
    assert merged == Counter((r.email, 1 if r.age > 40 else r.age) for r in users.collect())
    assert dedupe.insert_ignore(target, staging, "email").count() == users.count()


def rows_without_time(segments):
    return Counter(segments.drop("updated_at").collect())


def test_same_pair_twice_is_one_dim_user_row(spark):
    users = users_of(spark, user("1", "a", age=10), user("1", "a", age=40))
    assert star.repeated_ids(users).isEmpty()
    assert star_of(users)["fct_user"].count() == 2


def test_known_members_keep_their_ids(spark):
    users = users_of(spark, user("1", "a", address="An Giang"), user("2", "b", address="Cà Mau"))
    known = spark.createDataFrame([(7, "Cà Mau", "Nam")], "address_id int, province string, region string")
    assert as_set(star.dim_address(users, known=known)) == {(7, "Cà Mau", "Nam"), (8, "An Giang", "Nam")}


def test_any_number_of_addresses(spark):
    users = users_of(spark, *[user(str(i), str(i), address=f"place {i:03d}") for i in range(100)])
    built = star.dim_address(users)
    assert built.count() == built.select("province").distinct().count() == len(built.collect()) == 100


def test_maps_from_the_caller(spark):
    users = users_of(spark, user("1", "a", address="Here", occupation="Job"), user("2", "b", address="There", occupation=None))
    regions = spark.createDataFrame([("Here", "North"), ("Elsewhere", "South")], "key string, value string")
    assert as_set(star.dim_address(users, regions=regions)) == {(1, "Here", "North"), (2, "There", "Khác")}
    counts = insight.segment_insight(users, regions=regions, categories=regions.limit(0))
    found = {(r.segment_type, r.description): r.user_count for r in counts.collect()}
    assert found["region", "North"] == found["region", "Khác"] == found["occupation_group", "Khác"] == 1
    assert found["occupation_group", None] == 1


def test_merge_keeps_what_ids_mean(spark):
    old = star_of(users_of(spark, user("1", "a", address="An Giang"), user("07", "b", address="Cà Mau")))
    new = star_of(users_of(spark, user("7", "c", address="Gia Lai"), user("3", "d", address="An Giang")))
    merged = upsert_star(old, new)
    flat = {(r.user_id, r.email, r.province) for r in star.flat_star(merged).collect()}
    assert flat == {("1", "a", "An Giang"), ("7", "c", "Gia Lai"), ("3", "d", "An Giang")}
    with pytest.raises(ValueError):
        upsert_star(old, star_of(users_of(spark, user("x", "e"))))


# -- upsert -------------------------------------------------------------------------------------

@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")


def test_upsert(spark, target):
    staging = spark.createDataFrame([("B", 2), ("c", 3)], "v string, k int")
    merged = upsert(target, staging, "k")
    assert as_set(merged) == {(1, "a"), (2, "B"), (3, "c")}
    assert as_set(upsert(merged, staging, "k")) == {(1, "a"), (2, "B"), (3, "c")}


@pytest.mark.parametrize("rows", [[(2, "x"), (2, "y")], [(None, "x")]])
def test_upsert_rejects_bad_keys(spark, target, rows):
    with pytest.raises(DuplicateKeyError):
        upsert(target, spark.createDataFrame(rows, "k int, v string"), "k")


def test_upsert_parquet_needs_another_path(spark, target, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    target.write.parquet(path)
    staging = spark.createDataFrame([(2, "B")], "k int, v string")
    with pytest.raises(ValueError):
        upsert_parquet(spark, path, staging, "k", path + "/")
    upsert_parquet(spark, path, staging, "k", out)
    assert as_set(spark.read.parquet(out)) == {(1, "a"), (2, "B")}


# -- integrity ------------------------------------------------------------------------------------

def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert as_set(integrity.pk_violations(df, "k")) == {(1, 2), (None, 2)}
    assert as_set(integrity.unique_violations(df, "k")) == {(1, 2)}


def test_fk_orphans(spark):
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "pk int")
    assert as_set(integrity.fk_orphans(child, "fk", parent, "pk")) == {(3, 2)}


def test_lengths_and_integers(spark):
    df = spark.createDataFrame(
        [("1", "Hà Nội"), ("x", None), ("3000000000", "An")], "k string, name string"
    )
    assert as_set(integrity.length_violations(df, "k", {"name": 5})) == {("1", "name", 6, 5)}
    assert as_set(integrity.int_violations(df, ["k"])) == {("k", "x"), ("k", "3000000000")}
    assert [r.k for r in integrity.with_int_keys(df, ["k"]).collect()] == [1, None, None]


def test_star_report(spark):
    users = users_of(spark, user("1", "a"), user("2", "b", gender="x" * 21), user("z", "c"))
    built = {name: staged(df, name) for name, df in star_of(users).items()}
    clean = {(r.constraint, r["table"], r.column): r.n_violations for r in integrity.star_report(built).collect()}
    assert len(clean) == 1 + 5 + 4 + 8 + 8
    assert {k: n for k, n in clean.items() if n} == {
        ("length", "fct_user", "gender"): 1,
        ("integer", "dim_user", "user_id"): 1,
        ("integer", "fct_user", "user_id"): 1,
        ("primary key", "dim_user", "user_id"): 1,
        ("primary key", "fct_user", "user_id"): 1,
    }
    same = {name: staged(df, name) for name, df in star_of(users_of(spark, user("7", "a"), user("07", "b"))).items()}
    found = integrity.star_report(same).where("n_violations > 0").collect()
    assert {(r.constraint, r["table"]) for r in found} == {("primary key", "dim_user"), ("primary key", "fct_user")}
    built["dim_address"] = built["dim_address"].where("province = 'nowhere'")
    broken = integrity.star_report(built).where("n_violations > 0 AND constraint = 'foreign key'")
    assert [r.column for r in broken.collect()] == ["address_id"]


def test_any_number_of_segments(spark):
    segments = spark.range(1_500).select(
        F.lit("age").alias("segment_type"), F.col("id").cast("string").alias("description"),
        F.lit(1).alias("user_count"),
    )
    numbered = insight.with_ids(segments)
    assert numbered.count() == numbered.agg(F.sum("user_count")).first()[0] == 1_500
    assert sorted(r.id for r in numbered.collect()) == list(range(1, 1_501))


def test_join_columns_do_not_depend_on_the_lookup(spark):
    rows = spark.createDataFrame([(1, "a")], "x int, k string")
    lookup = spark.createDataFrame([("a", 2)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        empty = joins.lookup_join(rows, lookup.limit(0), "k", how)
        assert empty.columns == joins.lookup_join(rows, lookup, "k", how).columns


def test_nested_columns_count_with_their_size(spark):
    rows = spark.range(100).select("id", F.array_repeat(F.lit(7), 10_000).alias("many"), F.lit(b"xyz" * 1000).alias("raw"))
    assert joins.measured_size(rows)[1] > 100 * 20_000
