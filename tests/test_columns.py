import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martmill.functions import columns as C


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(column.alias("x")).first()[0]


def test_rename_project_strict_and_reduced(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert C.rename_project(df, {"v": "value", "k": "key"}).columns == ["value", "key"]
    with pytest.raises(ValueError, match="gone"):
        C.rename_project(df, {"k": "key", "gone": "x"})
    assert C.rename_project(df, {"k": "key", "gone": "x"}, strict=False).columns == ["key"]


@pytest.mark.parametrize("code, label", [("F", "Female"), ("X", "Non-binary"), ("Q", None), (None, None)])
def test_map_codes(spark, code, label):
    labels = {"F": "Female", "M": "Male", "X": "Non-binary"}
    assert one(spark, C.map_codes("c", labels), c=("string", code)) == label


@pytest.mark.parametrize(
    "cents, dollars", [(1285, "12.85"), (0, "0.00"), (-5, "-0.05"), (None, None), (10**15 + 1, "10000000000000.01")]
)
def test_cents_to_dollars(spark, cents, dollars):
    got = one(spark, C.cents_to_dollars("c"), c=("bigint", cents))
    assert got == (Decimal(dollars) if dollars else None)


def test_cents_to_dollars_pre_cast_keeps_fractions(spark):
    assert one(spark, C.cents_to_dollars("c", "pre_cast"), c=("decimal(10,3)", Decimal("12.345"))) == Decimal("0.123500")
    with pytest.raises(ValueError):
        C.cents_to_dollars("c", "other")


def test_rounding_is_half_up(spark):
    assert one(spark, C.round_to("c", 2), c=("decimal(10,3)", Decimal("2.345"))) == Decimal("2.35")
    assert one(spark, C.round_to("c", 2), c=("decimal(10,3)", Decimal("-2.345"))) == Decimal("-2.35")


def test_scale_by_is_exact(spark):
    assert one(spark, C.scale_by("c", "0.95"), c=("decimal(10,2)", Decimal("0.10"))) == Decimal("0.0950")


@pytest.mark.parametrize("value, flag", [("jaffle", True), ("beverage", False), (None, False)])
def test_flag_equals(spark, value, flag):
    assert one(spark, C.flag_equals("c", "jaffle"), c=("string", value)) is flag


def test_derived_flag_keeps_null(spark):
    assert one(spark, C.derived_flag("c", 5), c=("int", None)) is None
    assert one(spark, C.derived_flag("c", 5), c=("int", 5)) is False


def test_trunc_day_ignores_the_session_zone(spark):
    late = dt.datetime(2079, 10, 27, 23, 59, 59, 999900)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert one(spark, C.trunc_day("c"), c=("timestamp_ntz", late)) == dt.datetime(2079, 10, 27)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_shift(spark):
    day = dt.date(2026, 3, 31)
    assert one(spark, C.date_shift("c", "month", -1), c=("date", day)) == dt.date(2026, 2, 28)
    assert one(spark, C.date_shift("c", "year", -20), c=("date", day)) == dt.date(2006, 3, 31)
    assert one(spark, C.date_shift("c", "day", 30), c=("date", day)) == dt.date(2026, 4, 30)
    with pytest.raises(ValueError):
        C.date_shift("c", "hour", 1)


def test_surrogate_key(spark):
    import hashlib

    got = one(spark, C.surrogate_key(["a", "b"]), a=("int", 7), b=("string", None))
    assert got == hashlib.md5(f"7-{C.NULL_KEY_TEXT}".encode()).hexdigest()


def test_concat_qualified(spark):
    got = one(spark, C.concat_qualified("a", "b", quote="`"), a=("string", "x"), b=("string", "y"))
    assert got == "`x`.`y`"
    assert one(spark, C.concat_qualified("a", "b"), a=("string", "x"), b=("string", None)) == "x"


def test_starts_with_takes_underscore_literally(spark):
    assert one(spark, C.starts_with_ci("c", "dev_"), c=("string", "DEV_1")) is True
    assert one(spark, C.starts_with_ci("c", "dev_"), c=("string", "devx1")) is False


def test_ilike_filter_with_empty_exclude_keeps_all(spark, rows):
    df = spark.createDataFrame([("Orders",), ("ORDER_items",), ("parts",)], "t string")
    assert rows(C.ilike_filter(df, "t", "order%")) == [("ORDER_items",), ("Orders",)]
    assert rows(C.ilike_filter(df, "t", "%", "%items")) == [("Orders",), ("parts",)]


def test_lists(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(df.filter(C.in_list("k", [1]))) == [(1,)]
    assert rows(df.filter(C.not_in_list("k", [1]))) == [(2,)]
    assert rows(df.filter(C.in_list("k", []))) == []


def test_range_filter_is_strict(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(C.range_filter(df, "k", 1, 3)) == [(2,)]
    assert rows(C.range_filter(df, "k", None, 3)) == [(1,), (2,)]


def test_mask_column(spark):
    assert one(spark, C.mask_column("c", True), c=("string", "a@b")) == "a@b"
    assert one(spark, C.mask_column("c", False), c=("string", "a@b")) == "REDACTED"
    assert one(spark, C.mask_column("c", F.lit(None).cast("boolean")), c=("string", "a@b")) == "REDACTED"


def test_safe_ratio(spark):
    assert one(spark, C.safe_ratio("a", "b"), a=("double", 1.0), b=("double", 0.0)) is None
    assert one(spark, C.safe_ratio("a", "b"), a=("double", 1.0), b=("double", 4.0)) == 0.25


def test_initcap_and_case_when(spark):
    assert one(spark, C.initcap("c"), c=("string", "in-transit NOW")) == "In-transit Now"
    kind = C.case_when((F.col("c") > 2, "big"), (F.col("c") > 1, "mid"))
    assert one(spark, kind, c=("int", 2)) == "mid"
    assert one(spark, kind, c=("int", 0)) is None


def test_sql_functions_equal_the_column_helpers(spark):
    from martmill.functions.sql import register_functions

    df = spark.createDataFrame([("12.85",), ("0.50",), ("-0.50",), ("101.49",), (None,)], "t string").select(F.col("t").cast("decimal(18,2)").alias("c"))
    assert "cents_to_dollars" in register_functions(spark) and register_functions(spark)
    names = {"default": "cents_to_dollars", "pre_cast": "cents_to_dollars_pre_cast", "rounded": "cents_to_dollars_rounded", "cast": "cents_to_dollars_cast"}
    for variant, name in names.items():
        both = spark.sql(f"SELECT {name}(c) AS x, c FROM {{df}}", df=df).withColumn("y", C.cents_to_dollars("c", variant))
        assert all(r["x"] == r["y"] for r in both.collect()), variant
        assert "cents_to_dollars" not in both._jdf.queryExecution().optimizedPlan().toString()
    got = [str(r[0]) for r in df.select(C.cents_to_dollars("c", "rounded")).collect()]
    assert got == ["0.13", "0.01", "-0.01", "1.01", "None"]
    assert spark.sql("SELECT mask_column('a', NULL), mask_column('a', true), flag_equals(NULL, 'a'), safe_ratio(1, 0)").first()[:3] == ("REDACTED", "a", False)
