"""Truth tables of the scalar expressions."""

from datetime import date

from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions import lookups, text


def apply(spark, expression, values, value_type="string"):
    """Evaluate a column expression on values, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"n int, v {value_type}")
    return [r[0] for r in rows.orderBy("n").select(expression(F.col("v"))).collect()]


def test_white_space_is_the_unicode_set():
    assert set(fv.WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip(spark):
    values = ["  a b ", "\ta\n", " a　", "", " \t", None]
    assert apply(spark, text.strip, values) == ["a b", "a", "a", "", "", None]


NUMBERS = {
    " 18 ": 18, "+5": 5, "-5": -5, "1_8": 18, "120": 120, "007": 7, " 42\t": 42,
    "": None, "  ": None, "abc": None, "18.7": None, "1e1": None, "1__8": None, "_18": None,
    "18_": None, "- 5": None, "123456789012": None, None: None,
}


def test_parse_int(spark):
    assert apply(spark, text.parse_int, list(NUMBERS)) == list(NUMBERS.values())


def test_numeric_id(spark):
    values = ["7", "007", "9223372036854775807", "9223372036854775808", "+7", " 7", "a1", "", None]
    assert apply(spark, text.numeric_id, values) == [7, 7, 9223372036854775807] + [None] * 6


def test_age_bucket(spark):
    ages = [1, 17, 18, 30, 31, 45, 46, 60, 61, 120, 0, -1, None]
    groups = [
        "Under 18", "Under 18", "18-30", "18-30", "31-45", "31-45", "46-60", "46-60",
        "Over 60", "Over 60", "18-30", "18-30", "Unknown",
    ]
    assert apply(spark, text.age_bucket, ages, "int") == groups
    text.register_sql_functions(spark)
    assert apply(spark, lambda c: F.expr("age_group(v)"), ages, "int") == groups


def test_email_slug(spark):
    names = ["Nguyễn Văn An", "ĐẶNG  THỊ\tMỹ Ý", "Trần Ngọc Hưởng", "Phạm Đức Vũ"]
    assert apply(spark, text.email_slug, names) == [
        "nguyen.van.an@gmail.com", "dang.thi.my.y@gmail.com", "tran.ngoc.huong@gmail.com",
        "pham.duc.vu@gmail.com",
    ]


def test_phone_format(spark):
    assert apply(spark, text.phone_format, ["0912345678"]) == ["0912 345 678"]


def test_register_date(spark):
    values = apply(spark, lambda c: text.register_date(date(2025, 7, 4), c), [0, 3, 5 * 365], "int")
    assert values == ["04/07/2025", "01/07/2025", "05/07/2020"]


def test_email_format(spark):
    values = ["x@y.z", "a@b.c@d", "a@bc", "@b.c", "", None]
    assert apply(spark, text.looks_like_email, values) == [True, True, False, False, False, None]


def test_regions(spark):
    values = ["An Giang", "Hà Nội", "TP. Hà Nội", "Khánh Hòa", "Khánh Hoà", "Unknown", "Gia Lai", None]
    assert apply(spark, lookups.province_region, values) == [
        "Nam", "Khác", "Bắc", "Khác", "Trung", "Unknown", "Trung", "Khác",
    ]


def test_accepted_provinces_with_a_region():
    assert len(fv.PROVINCES) == 63
    assert len(fv.PROVINCE_REGION) == 35
    assert sum(p in fv.PROVINCE_REGION for p in fv.PROVINCES) == 27


def test_categories(spark):
    values = ["Bác sĩ", "Giáo viên", "Công an", "Sinh viên", "", "Kế toán", None]
    assert apply(spark, lookups.occupation_category, values) == [
        "Y tế", "Khác", "Khác", "Khác", "Khác", "Kinh tế", "Khác",
    ]
