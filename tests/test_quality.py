import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martmill.operators import quality as Q
from martmill.plans import jaffle


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (3, "z")], "k int, v string")


def test_row_checks(spark, table, rows):
    assert rows(Q.check_not_null(table, "k"), "v") == [("c",), (None,)]
    assert rows(Q.check_unique(table, "k")) == [(1, 2)]
    assert rows(Q.check_accepted_values(table, "v", ["a", "b", "c"]), "v") == [("z",)]
    assert rows(Q.check_expression(table, "k < 3"), "k") == [(3,)]
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(Q.check_relationships(table, "k", parent, "p"), "k") == [(3,)]


def test_summary_matches_the_single_checks(spark, table):
    checks = [
        *Q.not_null_unique("t", "k"),
        Q.Check("accepted_values", "t", "v", ("a", "b")),
        Q.Check("expression", "t", "", "k < 3"),
        Q.Check("relationships", "t", "k", ("p", "p")),
    ]
    parent = spark.createDataFrame([(7,)], "p int")
    got = {(r["check"], r["column"]): r["failures"] for r in Q.run_checks({"t": table, "p": parent}, checks).collect()}
    assert got == {
        ("not_null", "k"): 2, ("unique", "k"): 1, ("accepted_values", "v"): 2, ("expression", ""): 1, ("relationships", "k"): 3,
    }
    with pytest.raises(ValueError):
        Q.run_checks({"t": table}, [Q.Check("odd", "t", "k")])


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(5).selectExpr("id AS a", "id AS b").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    summary = Q.run_checks({"t": t, "u": t}, [Q.Check("not_null", "t", "a"), Q.Check("not_null", "u", "b")])
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert sorted((r["table"], r["failures"]) for r in summary.collect()) == [("t", 0), ("u", 0)]


def _item(**changes):
    row = dict(
        order_item_id="i", order_id="o", product_id="p", customer_id="c", ordered_at=dt.datetime(2024, 1, 1),
        product_name="n", product_price=Decimal("1.50"), is_food_item=True, is_drink_item=False, supply_cost=Decimal("0.1234"),
    )
    return {**row, **changes}


SCHEMA = ("order_item_id string, order_id string, product_id string, customer_id string, ordered_at timestamp_ntz, "
          "product_name string, product_price decimal(16,2), is_food_item boolean, is_drink_item boolean, supply_cost decimal(29,4)")


def test_contract_casts_and_orders(spark):
    df = spark.createDataFrame([_item()], SCHEMA).select(*reversed([c.name for c in jaffle.ORDER_ITEMS_CONTRACT]))
    out = jaffle.contracted_order_items(df)
    assert [f.dataType for f in out.schema] == [f.dataType for f in Q.contract_schema(jaffle.ORDER_ITEMS_CONTRACT)]
    assert out.columns == [c.name for c in jaffle.ORDER_ITEMS_CONTRACT]
    assert out.first()["supply_cost"] == Decimal("0.12")


def test_contract_rejects_null_and_other_columns(spark):
    df = spark.createDataFrame([_item(), _item(customer_id=None)], SCHEMA)
    with pytest.raises(Exception, match="NULL in customer_id"):
        jaffle.contracted_order_items(df).collect()
    with pytest.raises(ValueError, match="supply_cost"):
        jaffle.contracted_order_items(df.drop("supply_cost"))
    with pytest.raises(ValueError, match="extra"):
        jaffle.contracted_order_items(df.withColumn("extra", F.lit(1)))


def test_second_version(spark):
    v2 = Q.project_version(spark.createDataFrame([_item()], SCHEMA), ["product_name"], {"supply_cost": "base_supply_cost"})
    assert set(jaffle.contracted_order_items(v2, 2).columns) == {
        c.name for c in jaffle.ORDER_ITEMS_CONTRACT
    } - {"supply_cost", "product_name"} | {"base_supply_cost"}


def test_compare_expected(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string")
    assert Q.compare_expected(a, a.orderBy(F.col("k").desc())).isEmpty()
    assert sorted(map(tuple, Q.compare_expected(a, b).collect()), key=repr) == [(1, "x", "actual", 1), (2, None, "actual", 1), (3, "y", "expected", 1)]
    with pytest.raises(ValueError):
        Q.compare_expected(a, b.withColumnRenamed("v", "w"))


def test_stores_are_opened_on_a_day(spark):
    """Opening times are cut to the day, not rounded."""
    schema = "id int, name string, tax_rate double, opened_at timestamp_ntz"
    raw = spark.createDataFrame([(4, "North Pier", 0.07, dt.datetime(2029, 2, 28, 23, 30)), (5, "Old Mill", 0.0, dt.datetime(2030, 1, 1))], schema)
    expected = spark.createDataFrame(
        [(4, "North Pier", 0.07, dt.datetime(2029, 2, 28)), (5, "Old Mill", 0.0, dt.datetime(2030, 1, 1))],
        "location_id int, location_name string, tax_rate double, opened_date timestamp_ntz",
    )
    assert Q.compare_expected(jaffle.stg_locations(raw).select(expected.columns), expected).isEmpty()


def test_keys_of_two_tables_meet_in_one_grouping(spark, tmp_path, rows):
    spark.createDataFrame([(1, 10), (2, 10), (2, None), (None, 99), (3, None), (None, 10)], "k int, p bigint").write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([(10, 1), (10, 2), (11, 3), (None, 4)], "p int, parent int").write.parquet(str(tmp_path / "p"))
    c, p = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
    checks = [
        *Q.not_null_unique("c", "k"), Q.Check("not_null", "c", "p"), Q.Check("relationships", "c", "p", ("p", "p")), *Q.not_null_unique("p", "p"),
        Q.Check("relationships", "p", "parent", ("c", "k")), Q.Check("relationships", "d", "k", ("c", "k")), Q.Check("expression", "c", "", "k > 1"), Q.Check("not_null", "p", "parent"),
    ]
    summary = Q.run_checks({"c": c, "p": p, "d": c}, checks)
    assert summary._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert rows(summary) == sorted([
        ("not_null", "c", "k", 2), ("unique", "c", "k", 1), ("not_null", "c", "p", 2), ("relationships", "c", "p", 1), ("not_null", "p", "p", 1), ("unique", "p", "p", 1),
        ("relationships", "p", "parent", 1), ("relationships", "d", "k", 0), ("expression", "c", "", 1), ("not_null", "p", "parent", 0),
    ], key=repr)
    with pytest.raises(ValueError):
        Q.run_checks({"c": c}, [])


def test_checks_of_empty_tables(spark, rows):
    empty = spark.createDataFrame([], "k int, v string")
    one = spark.createDataFrame([(1, "x")], "k int, v string")
    checks = [*Q.not_null_unique("e", "k"), Q.Check("relationships", "o", "k", ("e", "k")), Q.Check("relationships", "e", "k", ("o", "k"))]
    assert [r[3] for r in rows(Q.run_checks({"e": empty, "o": one}, checks))] == [0, 0, 1, 0]
