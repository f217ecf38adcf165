import datetime as dt

import pytest
from pyspark.sql import functions as F

from martmill.functions.calendar import date_spine
from martmill.operators import metrics as M
from martmill.plans import jaffle

D = dt.date


@pytest.fixture
def items(spark):
    data = [
        ("i1", "o1", "p", "c1", dt.datetime(2024, 1, 30), 10, 1),
        ("i2", "o1", "p", "c1", dt.datetime(2024, 1, 30), 20, 1),
        ("i3", "o2", "q", "c2", dt.datetime(2024, 1, 31), 5, 1),
        ("i4", "o3", "q", None, dt.datetime(2024, 3, 31), 60, 2),
    ]
    schema = "order_item_id string, order_id string, product_id string, customer_id string, ordered_at timestamp_ntz, product_price int, supply_cost int"
    orders = spark.createDataFrame(
        [("o1", "Here", 6, 40, dt.datetime(2024, 1, 30)), ("o3", "There", 5, 30, dt.datetime(2024, 3, 31))],
        "order_id string, location_name string, tax_rate_percent int, subtotal int, ordered_at timestamp_ntz",
    )
    return jaffle.order_item_model(spark.createDataFrame(data, schema), orders)


@pytest.fixture
def spine(spark):
    return date_spine(spark, D(2024, 1, 1), D(2024, 4, 1))


def values(df, *keys, value):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r[value] for r in df.collect()}


def test_revenue_shows_empty_days(items, spine):
    got = values(jaffle.metric("revenue", items, spine), "period", value="revenue")
    assert len(got) == 91
    assert {k: v for k, v in got.items() if v is not None} == {D(2024, 1, 30): 30, D(2024, 1, 31): 5, D(2024, 3, 31): 60}


def test_month_to_date_starts_anew(items, spine):
    got = values(jaffle.metric("mtd_revenue", items, spine), "period", value="mtd_revenue")
    assert len(got) == 91
    assert (got[D(2024, 1, 29)], got[D(2024, 1, 30)], got[D(2024, 1, 31)], got[D(2024, 2, 1)]) == (0, 30, 35, 0)
    cut = values(jaffle.metric("mtd_revenue", items, spine, start=D(2024, 1, 31), end=D(2024, 2, 2)), "period", value="mtd_revenue")
    assert cut == {D(2024, 1, 31): 35, D(2024, 2, 1): 0, D(2024, 2, 2): 0}


def test_month_to_date_by_dimension_carries_values_forward(spark, spine):
    daily = spark.createDataFrame(
        [("a", D(2024, 1, 2), 1), ("a", D(2024, 1, 30), 2), ("b", D(2024, 3, 31), 9)], "g string, period date, v int"
    )
    got = values(M.to_date_cumulative(daily, "v", spine, "t", "month", ["g"]), "g", "period", value="t")
    assert got[("a", D(2024, 1, 2))] == 1 and got[("a", D(2024, 1, 29))] == 1 and got[("a", D(2024, 1, 31))] == 3
    assert len([k for k in got if k[0] == "a"]) == 30
    assert [k for k in got if k[0] == "b"] == [("b", D(2024, 3, 31))]


def test_last_month_leaves_gaps(items, spine):
    got = values(jaffle.metric("monthly_revenue_l1m", items, spine), "period", value="monthly_revenue_l1m")
    assert got == {D(2024, 1, 1): None, D(2024, 2, 1): 35, D(2024, 3, 1): None}


def test_growth(items, spine):
    got = values(jaffle.metric("mom_revenue_performance", items, spine), "period", value="mom_revenue_performance")
    assert got == {D(2024, 1, 1): None, D(2024, 2, 1): None, D(2024, 3, 1): None}
    extra = items.table.unionByName(
        items.table.limit(1).withColumn("ordered_at", F.lit("2024-02-10").cast("timestamp_ntz")).withColumn("product_price", F.lit(70))
    )
    got = values(jaffle.metric("mom_revenue_performance", jaffle.order_item_model(extra), spine), "period", value="mom_revenue_performance")
    assert got == {D(2024, 1, 1): None, D(2024, 2, 1): 1.0, D(2024, 3, 1): 60 / 70 - 1}


def test_growth_by_a_dimension_with_nulls(items, spine):
    got = values(
        jaffle.metric("mom_revenue_performance", items, spine, group_by=("customer",)), "period", "customer", value="previous_month"
    )
    assert got == {
        (D(2024, 1, 1), "c1"): None, (D(2024, 1, 1), "c2"): None, (D(2024, 2, 1), "c1"): 30, (D(2024, 2, 1), "c2"): 5,
        (D(2024, 3, 1), None): None,
    }


def test_distinct_orders_do_not_add_up(items, spine):
    by_product = values(jaffle.metric("order_count", items, spine, grain=None, group_by=("product",)), "product", value="order_count")
    assert by_product == {"p": 1, "q": 2}
    assert jaffle.metric("order_count", items, spine, grain="year").first()["order_count"] == 3


def test_ratio_divides_totals(items, spine):
    got = values(jaffle.metric("average_order_amount", items, spine, grain="month"), "period", value="average_order_amount")
    assert got == {D(2024, 1, 1): 17.5, D(2024, 2, 1): None, D(2024, 3, 1): 60.0}
    assert jaffle.metric("average_order_amount", items, spine, grain=None).first()["average_order_amount"] == 95 / 3


def test_linked_dimensions(items, spine):
    got = values(jaffle.metric("revenue", items, spine, grain=None, group_by=("high_tax_area",)), "high_tax_area", value="revenue")
    assert got == {True: 30, False: 60, None: 5}
    got = values(jaffle.metric("revenue", items, spine, grain=None, group_by=("large_order",)), "large_order", value="revenue")
    assert got == {True: 30, False: 60, None: 5}


def test_market_share(spark, items, spine):
    market = jaffle.market_model(
        spark.createDataFrame([(D(2024, 1, 1), 1, 2, 70), (D(2024, 2, 1), 1, 2, 0)], jaffle.MARKET_SCHEMA)
    )
    got = values(jaffle.metric("jaffle_market_share", items, spine, market), "period", value="jaffle_market_share")
    assert got == {D(2024, 1, 1): 0.5, D(2024, 2, 1): None, D(2024, 3, 1): None}
    assert jaffle.metric("market_food_sales", items, spine, market, grain="year").first()["market_food_sales"] == 2
    with pytest.raises(ValueError):
        jaffle.metric("jaffle_market_share", items, spine)
    with pytest.raises(KeyError):
        jaffle.metric("profit", items, spine, market)


def test_leaderboard(items):
    assert values(jaffle.customer_leaderboard(items), "customer", value="revenue") == {"c1": 30, "c2": 5, None: 60}


def test_every_metric_answers(spark, items, spine):
    market = jaffle.market_model(spark.createDataFrame([(D(2024, 1, 1), 1, 2, 70)], jaffle.MARKET_SCHEMA))
    for name in jaffle.METRICS:
        assert name in jaffle.metric(name, items, spine, market, grain="month").columns


@pytest.mark.parametrize("name", jaffle.METRICS)
def test_every_argument_counts_or_raises(spark, items, spine, name):
    market = jaffle.market_model(spark.createDataFrame([(D(2024, 1, 1), 1, 2, 70)], jaffle.MARKET_SCHEMA))
    for grain in ("day", "month", "quarter", "year", None):
        if grain in jaffle.GRAINS.get(name, (grain,)):
            periods = [c for c in jaffle.metric(name, items, spine, market, grain=grain).columns if c == "period"]
            assert len(periods) == (grain is not None)
        else:
            with pytest.raises(ValueError):
                jaffle.metric(name, items, spine, market, grain=grain)
    if name in jaffle.MARKET_ONLY:
        with pytest.raises(ValueError):
            jaffle.metric(name, items, spine, market, ("customer",))
    else:
        assert "customer" in jaffle.metric(name, items, spine, market, ("customer",)).columns
    with pytest.raises(Exception):
        jaffle.metric(name, items, spine, market, ("no_such_dimension",)).collect()


def test_month_to_date_by_month(items, spine):
    by_month = values(jaffle.metric("mtd_revenue", items, spine, grain="month"), "period", value="mtd_revenue")
    by_day = values(jaffle.metric("mtd_revenue", items, spine), "period", value="mtd_revenue")
    assert by_month == {m: by_day[max(d for d in by_day if (d.year, d.month) == (m.year, m.month))] for m in by_month}
