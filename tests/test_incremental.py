import datetime as dt
import glob
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martmill.operators import incremental as I
from martmill.plans import bikeshop, tpch
from martmill.session import materialise, shared_dir


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v int")


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_scratch_goes_to_the_configured_folder(spark, shared):
    assert shared_dir(spark) == shared
    stored = materialise(kv(spark, (1, 2)), "probe")
    assert all(f.removeprefix("file://").startswith(shared) for f in stored.inputFiles())


def test_watermarks(spark, rows):
    target, delta = kv(spark, (1, 5)), kv(spark, (2, 4), (3, 5), (4, 6))
    assert rows(I.inc_watermark_strict(delta, target, "v")) == [(4, 6)]
    empty = target.limit(0)
    assert rows(I.inc_watermark_strict(delta, empty, "v")) == []
    assert rows(I.inc_watermark_strict(delta, None, "v")) == rows(delta)

    as_days = lambda df: df.withColumn("v", F.date_add(F.lit("2020-01-01").cast("date"), F.col("v")))
    got = I.inc_watermark_inclusive(as_days(delta), as_days(target), "v")
    assert rows(got, "k") == [(3,), (4,)]
    assert rows(I.inc_watermark_inclusive(as_days(delta), as_days(empty), "v"), "k") == [(2,), (3,), (4,)]


def test_upsert(spark, rows):
    target, delta = kv(spark, (1, 1), (2, 2), (None, 3)), kv(spark, (2, 20), (3, 30), (None, 9))
    assert rows(I.upsert_merge(target, delta, "k")) == [(1, 1), (2, 20), (3, 30), (None, 3), (None, 9)]
    twice = kv(spark, (2, 20), (2, 25), (None, 1), (None, 2))
    assert rows(I.upsert_merge(target, twice, "k", order=["v"])) == [(1, 1), (2, 25), (None, 1), (None, 2), (None, 3)]


def test_delete_insert_keeps_all_delta_rows(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, l int, v string")
    delta = spark.createDataFrame([(1, 2, "c"), (1, 2, "d")], "k int, l int, v string")
    assert rows(I.upsert_delete_insert(target, delta, ["k", "l"])) == [(1, 1, "a"), (1, 2, "c"), (1, 2, "d")]


def test_append_is_repeatable(spark, rows):
    table = kv(spark, (1, 1)).withColumn("b", F.lit(1))
    for _ in range(3):
        table = I.append_only(table, kv(spark, (2, 2)), "b", 2)
    assert rows(table) == [(1, 1, 1), (2, 2, 2)]


def test_new_columns(spark, rows):
    wide = kv(spark, (1, 1)).withColumn("w", F.lit("x"))
    assert rows(I.append_new_columns(kv(spark, (0, 0)), wide)) == [(0, 0, None), (1, 1, "x")]
    assert rows(I.append_new_columns(wide, kv(spark, (0, 0)))) == [(0, 0, None), (1, 1, "x")]


def test_microbatch_empties_days_without_new_rows(spark, rows):
    day = lambda n: dt.datetime(2024, 1, n, 12)
    schema = "t timestamp_ntz, v int"
    target = spark.createDataFrame([(day(1), 1), (day(2), 2), (day(3), 3), (None, 4)], schema)
    batch = spark.createDataFrame([(day(1), 10), (day(3), 30)], schema)
    out = I.microbatch_replace(target, batch, "t", dt.date(2024, 1, 2), dt.date(2024, 1, 4))
    assert rows(out, "v") == [(1,), (30,), (4,)]


def test_stored_table(spark, name, rows):
    table = I.StoredTable(spark, name)
    assert table.read() is None
    table.append(kv(spark, (1, 1)))
    table.append(kv(spark, (2, 2)).withColumn("w", F.lit("x")))
    table.append(kv(spark, (3, 3)).select("v", "k"))
    assert rows(table.read()) == [(1, 1, None), (2, 2, "x"), (3, 3, None)]
    I.load_incremental(table, lambda target: I.inc_anti_key(kv(spark, (3, 9), (4, 4)), target, "k"))
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 2), (3, 3), (4, 4)]
    with pytest.raises(ValueError, match="column v"):
        table.append(kv(spark, (5, 5)).withColumn("v", F.lit("text")))


def test_a_failing_load_keeps_the_table(spark, name, rows):
    broken = F.raise_error(F.lit("no")).cast("int")
    table = I.StoredTable(spark, name)
    table.append(kv(spark, (1, 1)))
    with pytest.raises(Exception, match="no"):
        table.append(kv(spark, (2, 2)).withColumn("v", broken))
    assert rows(table.read()) == [(1, 1)]
    periods = I.PeriodTable(spark, f"{name}_p", "m", ["k"])
    jan = dt.date(2024, 1, 5)
    periods.create(_orders(spark, (1, jan, 1)))
    with pytest.raises(Exception, match="no"):
        periods.replace_mentioned(_orders(spark, (2, jan, 1)).withColumn("v", broken))
    assert rows(periods.read(), "k", "v") == [(1, 1)]


def _month(df):
    return df.withColumn("m", F.trunc("d", "month"))


def _orders(spark, *items):
    return _month(spark.createDataFrame(list(items), "k int, d date, v int"))


def test_period_table_rewrites_touched_periods_only(spark, name, rows):
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan, feb, mar, apr = (dt.date(2024, n, 5) for n in (1, 2, 3, 4))
    table.upsert(_orders(spark, (1, jan, 1), (2, feb, 2), (3, mar, 3)))
    files = lambda p: sorted(table.read().filter(f"m = DATE '{p}'").inputFiles())
    before = {p: [f for f in files(p) if f"m={p}" in f] for p in table.periods()}
    assert sorted(before) == ["2024-01-01", "2024-02-01", "2024-03-01"]
    # Key 2 leaves February, key 4 is new, January is not touched.
    table.upsert(_orders(spark, (2, mar, 20), (4, apr, 4)))
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (3, 3), (4, 4)]
    assert table.periods() == ["2024-01-01", "2024-03-01", "2024-04-01"]
    assert [f for f in files("2024-01-01") if "m=2024-01-01" in f] == before["2024-01-01"] != []
    assert rows(table.last_period(), "k") == [(4,)]
    table.upsert(_orders(spark, (2, mar, 20), (4, apr, 4)))  # once more, as after a failed try
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (3, 3), (4, 4)]


def test_period_table_replace(spark, name, rows):
    table = I.PeriodTable(spark, name, "m", ["k"])
    table.create(_orders(spark, *[(n, dt.date(2024, n, 1), n) for n in range(1, 6)]))
    batch = _orders(spark, (2, dt.date(2024, 2, 9), 20), (5, dt.date(2024, 5, 1), 50))
    table.replace(batch, dt.date(2024, 2, 1), dt.date(2024, 4, 1))
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (4, 4), (5, 5)]


def test_rows_without_a_period(spark, name, rows):
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan = dt.date(2024, 1, 5)
    table.upsert(_orders(spark, (1, None, 1), (2, jan, 2), (3, None, 3)))
    table.upsert(_orders(spark, (1, jan, 10), (2, None, 20)))
    assert rows(table.read(), "k", "v", "d") == [(1, 10, jan), (2, 20, None), (3, 3, None)]
    assert table.periods() == ["2024-01-01"]
    table.upsert(_orders(spark, (2, jan, 21), (3, jan, 31)))
    assert rows(table.read(), "k", "v") == [(1, 10), (2, 21), (3, 31)]


def test_keys_that_never_move(spark, name, rows):
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    table.create(_orders(spark, (1, jan, 1), (2, feb, 2)))
    table.upsert(_orders(spark, (2, feb, 20), (3, feb, 30)), keys_move=False)
    assert rows(table.read(), "k", "v") == [(1, 1), (2, 20), (3, 30)]


def test_columns_that_arrive_later_survive(spark, name, rows):
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    table.upsert(_orders(spark, (1, jan, 1), (2, feb, 2)))
    table.upsert(_orders(spark, (3, feb, 3)).withColumn("w", F.lit("x")))
    table.upsert(_orders(spark, (4, feb, 4), (1, jan, 5)))
    assert rows(table.read(), "k", "v", "w") == [(1, 5, None), (2, 2, None), (3, 3, "x"), (4, 4, None)]
    with pytest.raises(ValueError, match="column v"):
        table.upsert(_orders(spark, (4, feb, 4)).withColumn("v", F.lit("text")))


def test_empty_loads_and_emptied_tables(spark, name, rows):
    jan = dt.date(2024, 1, 5)
    for n, first in enumerate((_orders(spark, (1, jan, 1)).limit(0), _orders(spark, (1, jan, 1)))):
        table = I.PeriodTable(spark, f"{name}_{n}", "m", ["k"])
        assert table.read() is None and table.last_period() is None
        table.upsert(first)
        table.replace(first.limit(0), dt.date(2024, 1, 1), dt.date(2025, 1, 1))
        assert rows(table.read()) == [] and table.read().columns == first.columns and table.periods() == []
        fresh = _orders(spark, (2, jan, 2))
        assert rows(I.inc_watermark_strict(fresh, table.last_period(), "v")) == []
        stored = I.StoredTable(spark, f"{name}_{n}_stored")
        stored.append(first.limit(0))
        assert rows(I.inc_watermark_strict(fresh, stored.read(), "v")) == []
        table.upsert(fresh)
        assert rows(table.read(), "k") == [(2,)]


def test_one_rule_for_keys(spark, name, rows):
    """Repeated keys fail without an order, on first and later loads; rows without a key all stay."""
    jan = dt.date(2024, 1, 5)
    twice = _orders(spark, (1, jan, 1), (1, jan, 2), (None, jan, 3), (None, jan, 3))
    table = I.PeriodTable(spark, name, "m", ["k"])
    with pytest.raises(ValueError, match="several rows"):
        table.upsert(twice)
    assert table.read() is None
    table.upsert(twice, order=["v"])
    with pytest.raises(ValueError, match="several rows"):
        table.upsert(twice)
    assert rows(table.read(), "k", "v") == [(1, 2), (None, 3), (None, 3)]
    table.upsert(_orders(spark, (1, jan, 9), (None, jan, 4)))
    assert rows(table.read(), "k", "v") == [(1, 9), (None, 3), (None, 3), (None, 4)]


@pytest.mark.parametrize("how", ["replace", "replace_mentioned"])
def test_a_replacement_may_come_first(spark, name, rows, how):
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    bounds = (dt.date(2024, 1, 1), dt.date(2024, 3, 1)) if how == "replace" else ()
    getattr(table, how)(_orders(spark, (1, jan, 1), (2, feb, 2)), *bounds)
    table.upsert(_orders(spark, (3, jan, 3)))
    assert rows(table.read(), "k") == [(1,), (2,), (3,)]


def test_a_period_must_be_a_date(spark, name):
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan = _orders(spark, (1, dt.date(2024, 1, 5), 1))
    for kind in ("timestamp_ntz", "timestamp", "string"):
        for load in (table.create, table.upsert, table.replace_mentioned):
            with pytest.raises(TypeError, match="must be a date"):
                load(jan.withColumn("m", F.col("m").cast(kind)))
    assert table.read() is None


def test_the_last_row_leaves_a_period(spark, name, rows):
    """Periods that a moved key empties are gone, also the one of rows without a period; others keep what stays."""
    table = I.PeriodTable(spark, name, "m", ["k"])
    jan, feb, mar = (dt.date(2024, n, 5) for n in (1, 2, 3))
    table.upsert(_orders(spark, (1, jan, 1), (2, feb, 2), (3, feb, 3), (4, None, 4)))
    table.upsert(_orders(spark, (1, mar, 10), (2, mar, 20), (4, mar, 40)))
    assert rows(table.read(), "k", "v", "d") == [(1, 10, mar), (2, 20, mar), (3, 3, feb), (4, 40, mar)]
    assert table.periods() == ["2024-02-01", "2024-03-01"]


def test_a_hot_period_is_written_by_several_tasks(spark, name, tmp_path):
    table = I.PeriodTable(spark, name, "m", ["k"], str(tmp_path / "t"))
    df = spark.range(30000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("date").alias("m"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")  # as with much data
    try:
        table.create(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = glob.glob(str(tmp_path / "t/m=2024-01-01/*.parquet"))
    assert len(files) > 2


pairs = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=pairs, second=pairs)
def test_two_merges_equal_one(spark, first, second):
    """Merging two batches one after the other equals merging both, later batch last."""
    load = lambda data, n: spark.createDataFrame([(k, v, n) for k, v in data], "k int, v int, n int")
    empty = load([], 0)
    order = ["n", "v"]
    stepwise = I.upsert_merge(I.upsert_merge(empty, load(first, 1), "k", order), load(second, 2), "k", order)
    at_once = I.upsert_merge(empty, load(first, 1).unionByName(load(second, 2)), "k", order)
    assert sorted(stepwise.collect()) == sorted(at_once.collect())


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=pairs, second=pairs)
def test_anti_key_loads_each_key_once(spark, first, second):
    load = lambda data: kv(spark, *dict(data).items()) if data else spark.createDataFrame([], "k int, v int")
    target = load(first)
    out = I.append_new_columns(target, I.inc_anti_key(load(second), target, "k"))
    assert dict(out.collect()) == {**dict(second), **dict(first)}


def _bike(spark, lines):
    lines = spark.createDataFrame(lines, "order_product_id string, product_id int, order_id int, order_product_quantity int, loaded_at int")
    products = spark.createDataFrame([(1, 100, 10)], "product_id int, product_price int, product_cost int")
    products = products.withColumn("product_cost", F.col("product_cost").cast("decimal(15,2)"))
    orders = spark.createDataFrame([(7, 70, dt.date(2024, 1, 1))], "order_id int, customer_id int, order_date date")
    return lines, products, orders


def test_order_product_site_that_takes_new_keys(spark, name):
    """A late row, a changed row, and an orphan."""
    table = I.StoredTable(spark, name)
    bikeshop.run_fct_order_products(table, *_bike(spark, [("a", 1, 7, 1, 5), ("b", 9, 8, 1, 6)]), bikeshop.PLAIN)
    assert table.read().count() == 2
    second = [("a", 1, 7, 4, 8), ("b", 9, 8, 1, 6), ("late", 1, 7, 1, 6), ("new", 1, 7, 1, 9)]
    out = {r["order_product_id"]: r for r in bikeshop.run_fct_order_products(table, *_bike(spark, second), bikeshop.PLAIN).collect()}
    assert sorted(out) == ["a", "b", "late", "new"] and out["a"]["order_product_quantity"] == 1
    assert out["b"]["customer_id"] is None and out["b"]["product_price"] is None and "loaded_at" not in out["a"].asDict()
    with pytest.raises(ValueError, match="by period"):
        bikeshop.run_fct_order_products(table, *_bike(spark, second), bikeshop.MERGING)


def test_merging_site_by_month(spark, name):
    def stamped(lines):
        lines, products, orders = _bike(spark, lines)
        at = F.timestamp_add("HOUR", F.col("loaded_at") * 300, F.lit("2024-01-01").cast("timestamp_ntz"))
        return lines.withColumn("loaded_at", at.cast("timestamp_ntz")), products, orders

    table = I.PeriodTable(spark, name, "loaded_month", ["order_product_id"])
    bikeshop.run_fct_order_products(table, *stamped([("a", 1, 7, 1, 1), ("b", 9, 8, 1, 6)]), bikeshop.MERGING)
    second = [("a", 1, 7, 4, 8), ("a", 1, 7, 3, 7), ("late", 1, 7, 1, 6), ("new", 1, 7, 1, 9)]
    out = bikeshop.run_fct_order_products(table, *stamped(second), bikeshop.MERGING)
    assert {r["order_product_id"]: r["order_product_quantity"] for r in out.collect()} == {"a": 4, "b": 1, "new": 1}
    with pytest.raises(ValueError):
        bikeshop.run_fct_order_products(table, *stamped(second), bikeshop.PLAIN)


def test_discounting_site_leaves_a_csv_copy(spark, name, tmp_path):
    site = bikeshop.SiteOptions(cost_factor="0.95", export_dir=str(tmp_path / "csv"))
    bikeshop.run_fct_order_products(I.StoredTable(spark, name), *_bike(spark, [("a", 1, 7, 1, 5)]), site)
    copy = spark.read.option("header", True).csv(site.export_dir).first()
    assert float(copy["product_cost"]) == 9.5


def test_order_facts_reload_the_last_day(spark, name):
    day = lambda n: dt.datetime(2024, 1, n)
    schema = "order_id int, customer_id int, order_total int, order_date timestamp_ntz"
    geo = spark.createDataFrame([(1, "EUROPE", "BUILDING")], "customer_id int, region_name string, market_segment string")
    table = I.PeriodTable(spark, name, "order_month", ["order_id"])
    tpch.run_orders_fact(table, spark.createDataFrame([(1, 1, 10, day(1)), (2, 1, 20, day(5))], schema), geo)
    again = [(1, 1, 11, day(1)), (2, 1, 21, day(5)), (3, 2, 30, day(5)), (4, 1, 40, day(6))]
    tpch.run_orders_fact(table, spark.createDataFrame(again, schema), geo)
    got = {r["order_id"]: (r["order_total"], r["region_name"]) for r in table.read().collect()}
    assert got == {1: (10, "EUROPE"), 2: (21, "EUROPE"), 3: (30, None), 4: (40, "EUROPE")}
