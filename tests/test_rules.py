"""Truth tables of the cleaning profiles."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from segmart.operators import joins, rules
from segmart.sources import lists

GOOD = {
    "_id": "1", "name": "An", "email": "an@x.vn", "phone": "0912", "gender": "Male", "age": "30",
    "address": "Gia Lai", "occupation": "Y tá",
}
ABSENT = object()


def changed(**fields):
    record = {**GOOD, **fields}
    return {k: v for k, v in record.items() if v is not ABSENT}


def only(frame):
    """The single row as a dictionary, None when there is none."""
    rows = frame.collect()
    assert len(rows) <= 1
    return rows[0].asDict() if rows else None


def strict(landing, **fields):
    return only(rules.clean_strict(landing(changed(**fields))))


def sentinel(landing, **fields):
    return only(rules.clean_sentinel(landing(changed(**fields))))


def tag(landing, **fields):
    return only(rules.tag_columns(landing(changed(**fields))))


def test_good_record_passes_all_profiles(landing):
    expected = {**GOOD, "age": 30}
    assert strict(landing) == expected
    assert sentinel(landing) == expected
    assert tag(landing) == GOOD


UNREADABLE = [
    None, "", "  ", "bad", '{"a":1', "[1]", '[{"_id":"1"}]', "null", "12", '"text"',
    json.dumps(GOOD) + " xyz", json.dumps(GOOD) + json.dumps(GOOD),
    json.dumps(GOOD) + "," + json.dumps(GOOD), json.dumps(GOOD) + "] x",
    str(GOOD), json.dumps(GOOD)[:-1] + ",}",
]


def test_unreadable_texts_drop_out(landing):
    assert rules.clean_strict(landing(*UNREADABLE)).count() == 0
    assert rules.clean_sentinel(landing(*UNREADABLE)).count() == 0


def test_unreadable_texts_are_tagged(landing):
    rows = rules.clean_tag(landing(*UNREADABLE)).collect()
    assert len(rows) == len(UNREADABLE)
    fields = ("id", "name", "email", "phone", "gender", "age", "address", "occupation")
    assert all(json.loads(r.cleaned_data) == dict.fromkeys(fields, "N/A") for r in rows)
    assert {r._id for r in rules.tag_columns(landing(*UNREADABLE)).collect()} == {None}


def test_empty_object(landing):
    assert rules.clean_strict(landing("{}")).count() == 0
    assert rules.clean_sentinel(landing("{}")).count() == 0
    assert set(only(rules.tag_columns(landing("{}"))).values()) == {"N/A"}


def test_last_of_repeated_keys_wins(landing):
    text = json.dumps(GOOD)[:-1] + ', "name": "Bình", "age": 31}'
    row = only(rules.clean_strict(landing(text)))
    assert (row["name"], row["age"]) == ("Bình", 31)


@pytest.mark.parametrize("field", ["_id", "name", "email"])
def test_strict_required(landing, field):
    records = [changed(**{field: value}) for value in (ABSENT, None, "")]
    assert rules.clean_strict(landing(*records)).count() == 0


def test_strict_takes_any_email_text(landing):
    assert strict(landing, email="not-an-email")["email"] == "not-an-email"


# Per field: value, then what the strict, sentinel and tag profiles make of it.
DROP = "the row is dropped"
GENDERS = [
    ("Male", "Male", "Male", "Male"),
    ("female", "Female", "female", "N/A"),
    ("MALE", "Male", "MALE", "N/A"),
    ("oTHER", "Other", "oTHER", "N/A"),
    ("boy", "Male", "Male", "Male"),
    ("BOY", "Male", "Male", "Male"),
    ("Girl", "Female", "Female", "Female"),
    (" male", DROP, DROP, "N/A"),
    ("malee", DROP, DROP, "N/A"),
    ("Unkown", DROP, DROP, "N/A"),
    ("N/A", DROP, DROP, "N/A"),
    ("", None, DROP, "N/A"),
    (None, None, DROP, "N/A"),
    (ABSENT, None, DROP, "N/A"),
]
AGES = [
    ("1", 1, 1, "1"), ("120", 120, 120, "120"), (" 18 ", 18, 18, "18"), ("+5", 5, 5, "5"),
    ("1_8", 18, 18, "18"), (25, 25, 25, "25"), (25.7, 25, 25, "25"), (True, 1, 1, "1"),
    (120.9, 120, 120, "120"),
    ("0", DROP, DROP, "N/A"), ("-1", DROP, DROP, "N/A"), ("121", DROP, DROP, "N/A"),
    ("18.7", DROP, DROP, "N/A"), ("1e1", DROP, DROP, "N/A"), ("", DROP, DROP, "N/A"),
    ("123456789012", DROP, DROP, "N/A"), (0.9, DROP, DROP, "N/A"), (False, DROP, DROP, "N/A"),
    ([30], DROP, DROP, "N/A"), ("mười tám", DROP, DROP, "N/A"),
    (None, None, DROP, "N/A"),
    (ABSENT, None, -1, "N/A"),
]
ADDRESSES = [
    ("Gia Lai", "Gia Lai", "Gia Lai", "Gia Lai"),
    ("\tCà Mau \n", "Cà Mau", "Cà Mau", "Cà Mau"),
    ("\u00a0An Giang\u00a0", "An Giang", "An Giang", "An Giang"),
    ("Khánh Hòa", "Khánh Hòa", "Khánh Hòa", "Khánh Hòa"),
    ("Khánh Hoà", DROP, DROP, "Invalid"),
    ("TP. Hà Nội", DROP, DROP, "Invalid"),
    ("Atlantis", DROP, DROP, "Invalid"),
    ("  ", DROP, DROP, "Invalid"),
    ("N/A", DROP, "N/A", "N/A"),
    ("", None, DROP, "Invalid"),
    (None, None, DROP, "N/A"),
    (ABSENT, None, DROP, "N/A"),
]
OCCUPATIONS = [
    ("Y tá", "Y tá", "Y tá", "Y tá"), ("", "", "", ""), (None, "", None, None),
    (ABSENT, "", "Unkown", "N/A"),
]
PHONES = [(ABSENT, None, None, "N/A"), (None, None, None, None), ("", "", "", "")]


@pytest.mark.parametrize("place, profile", list(enumerate([rules.clean_strict, rules.clean_sentinel, rules.tag_columns], 1)))
@pytest.mark.parametrize(
    "field, table",
    [
        ("gender", GENDERS), ("age", AGES), ("address", ADDRESSES), ("occupation", OCCUPATIONS),
        ("phone", PHONES),
    ],
)
def test_field(landing, field, table, place, profile):
    rows = landing(*[changed(_id=str(i), **{field: case[0]}) for i, case in enumerate(table)])
    got = {row._id: row[field] for row in profile(rows).collect()}
    wanted = {str(i): case[place] for i, case in enumerate(table) if case[place] is not DROP}
    assert got == wanted


@pytest.mark.parametrize("place, profile", list(enumerate([rules.clean_strict, rules.clean_sentinel, rules.tag_columns], 1)))
def test_address_against_a_table(spark, landing, place, profile):
    rows = landing(*[changed(_id=str(i), address=case[0]) for i, case in enumerate(ADDRESSES)])
    got = {row._id: row.address for row in profile(rows, lists.city_list(spark)).collect()}
    assert got == {str(i): c[place] for i, c in enumerate(ADDRESSES) if c[place] is not DROP}


def test_id_of_lenient_profiles(landing):
    cases = [(ABSENT, "None", "N/A"), (None, "None", "None"), ("", "", ""), (7, "7", "7")]
    rows = landing(*[changed(_id=case[0], name=str(i)) for i, case in enumerate(cases)])
    for place, profile in ((1, rules.clean_sentinel), (2, rules.tag_columns)):
        got = {row.name: row._id for row in profile(rows).collect()}
        assert got == {str(i): case[place] for i, case in enumerate(cases)}


def test_tag_email(landing):
    cases = [("x@y.z", "x@y.z"), ("a@b.c@d", "a@b.c@d"), ("a@bc", "N/A"), ("", "N/A"), (None, "N/A"), (ABSENT, "N/A"), (5, "N/A")]
    rows = landing(*[changed(_id=str(i), email=case[0]) for i, case in enumerate(cases)])
    assert {r._id: r.email for r in rules.tag_columns(rows).collect()} == {str(i): c[1] for i, c in enumerate(cases)}


def test_sentinel_keeps_missing_name_and_email(landing):
    row = sentinel(landing, name=ABSENT, email=None)
    assert (row["name"], row["email"]) == (None, None)


@pytest.mark.parametrize("profile", [rules.clean_strict, rules.clean_sentinel, rules.tag_columns])
def test_province_table_too_large_to_broadcast(spark, landing, monkeypatch, profile):
    rows = landing(*[changed(_id=str(i), address=a) for i, a in enumerate([" Cà Mau ", "Atlantis", ABSENT, "Gia Lai"] * 5)])
    wanted = Counter(profile(rows).collect())
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    assert Counter(profile(rows, lists.city_list(spark)).collect()) == wanted


def test_tag_keeps_extra_keys_and_types(landing):
    record = changed(age="30", phone=912, occupation=None, register_date="04/07/2025", score=1.5, tags=["a"])
    row = rules.clean_tag(landing(record)).first()
    assert json.loads(row.cleaned_data) == {**record, "age": 30}
    assert json.loads(row._airbyte_data) == record


def test_tag_keeps_other_landing_columns(landing):
    rows = landing(GOOD).withColumn("address", F.lit("envelope"))
    row = rules.clean_tag(rows).first()
    assert row.address == "envelope"
    assert json.loads(row.cleaned_data)["address"] == "Gia Lai"


def test_parse_is_evaluated_once(landing):
    for profile in (rules.clean_strict, rules.clean_sentinel):
        plan = profile(landing(GOOD))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_strict_is_idempotent(spark, sf_dir):
    from segmart.functions.documents import record_to_json
    from segmart.plans.fixture import landing as landing_of

    once = rules.clean_strict(landing_of(spark, sf_dir))
    again = rules.clean_strict(once.select(record_to_json(*once.columns).alias("_airbyte_data")))
    assert once.count() == 85
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
