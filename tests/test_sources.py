import datetime as dt

import pyarrow.parquet as pq
import pytest
import os

from pyspark.sql import functions as F

from martmill.plans import jaffle, tpch
from martmill.sources import sinks
from martmill.sources import tables as T

MARKET = """report_month, food_sales, beverage_sales, total_sales
2031-02-01, 71, 12, 83
2031-03-01, 64, 30, 94
"""


def test_seed_with_blanks_after_commas(spark, tmp_path):
    path = tmp_path / "market.csv"
    path.write_text(MARKET)
    df = T.load_seed_csv(spark, str(path), jaffle.MARKET_SCHEMA)
    assert df.columns == ["report_month", "food_sales", "beverage_sales", "total_sales"]
    assert tuple(df.orderBy("report_month").first()) == (dt.date(2031, 2, 1), 71, 12, 83)


@pytest.mark.parametrize("text", ["food_sales, report_month, beverage_sales, total_sales\n1, 2031-02-01, 2, 3\n", MARKET.replace("71", "many")])
def test_seed_with_other_columns_or_bad_values_fails(spark, tmp_path, text):
    path = tmp_path / "market.csv"
    path.write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        T.load_seed_csv(spark, str(path), jaffle.MARKET_SCHEMA).collect()


def test_table_is_sorted_and_a_hot_value_fills_several_files(spark, tmp_path):
    df = spark.range(40000).withColumn("d", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with much data
    try:
        out = sinks.publish_table(df, "sorted_table", str(tmp_path / "t"), sort=["d"], spread=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = out.filter("d = 7").select(F.input_file_name()).distinct().count()
    assert out.count() == 40000 and hot > 2
    for name in out.inputFiles():
        values = [r[0] for r in spark.read.parquet(name).select("d").collect()]
        assert values == sorted(values)


def test_partitioned_table(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    out = sinks.publish_table(df, "parted", str(tmp_path / "t"), partition_by=["p"], spread=["k"])
    assert rows(out, "k", "p") == [(1, "a"), (2, "b")]
    (version,) = os.listdir(tmp_path / "t")
    assert sorted(n for n in os.listdir(tmp_path / "t" / version) if "=" in n) == ["p=a", "p=b"]


def _matching_files(table, column, low, high):
    """How many of the files may hold such a value, by the statistics in their footers."""
    found, files = 0, table.inputFiles()
    for name in files:
        meta = pq.ParquetFile(name.removeprefix("file://")).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        found += any(s.min <= high and s.max >= low for s in stats)
    return found, len(files)


def test_a_filter_on_either_column_skips_most_files(spark, tmp_path):
    df = spark.range(60_000).select("id", (F.xxhash64("id") % 1000).alias("a"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.abs(F.xxhash64("id", F.lit(1))) % 5000).alias("b"), F.concat(F.lit("k"), F.col("id") % 977).alias("s"))
    out = sinks.publish_table(df, "curved", str(tmp_path / "t"), spread=["id"], cluster=["a", "b"], files=64)
    assert out.count() == 60_000 and out.columns == df.columns
    for column, low, high in (("a", 10, 30), ("b", 4000, 4100)):
        found, files = _matching_files(out, column, low, high)
        assert files >= 48 and found <= files / 3, (column, found, files)
    hot, files = _matching_files(out, "b", 7, 7)
    assert hot > 8  # a third of the rows, in many files
    texts = sinks.publish_table(df, "curved_texts", str(tmp_path / "s"), spread=["id"], cluster=["s", "a"], files=64)
    found, files = _matching_files(texts, "s", "k10", "k11")
    assert texts.count() == 60_000 and found <= files / 3


def test_a_failed_rebuild_leaves_the_table(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 2), (3, 4)], "k int, v int")
    first = sinks.publish_table(df, "steady", str(tmp_path / "t"), spread=["k"], cluster=["k", "v"])
    bad = df.withColumn("v", F.when(F.col("k") > 1, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.publish_table(bad, "steady", str(tmp_path / "t"), spread=["k"], sort=["k"])
    assert rows(spark.table("steady")) == [(1, 2), (3, 4)]
    sinks.publish_table(df.withColumn("w", F.lit("new")), "steady", str(tmp_path / "t"), spread=["k"], sort=["k"])
    assert rows(first) == [(1, 2), (3, 4)] and rows(spark.table("steady")) == [(1, 2, "new"), (3, 4, "new")]
    assert len(sinks.prune_versions(spark, "steady", str(tmp_path / "t"))) >= 1
    assert rows(spark.table("steady")) == [(1, 2, "new"), (3, 4, "new")]
    empty = sinks.publish_table(df.limit(0), "steady", str(tmp_path / "t"), spread=["k"], cluster=["k", "v"])
    assert empty.count() == 0


def test_csv_export_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b")], "k int, v string")
    for _ in range(2):
        sinks.export_csv(df, str(tmp_path / "c"), delimiter=";")
    assert [tuple(r) for r in spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "c")).collect()] == [("1", "a;b")]


def test_clones_are_empty(spark, rows):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    clone = sinks.clone_schema(spark, df)
    assert clone.schema == df.schema and clone.count() == 0
    df.write.saveAsTable("clone_source")
    sinks.create_table_like(spark, "clone_copy", "clone_source")
    copy = spark.table("clone_copy")
    assert copy.count() == 0 and copy.dtypes == df.dtypes


def test_view_preview_and_count(spark, rows):
    view = sinks.publish_view(spark.range(5).toDF("k"), "five")
    assert rows(sinks.preview(view, 2, ["k"])) == [(0,), (1,)]
    assert rows(sinks.row_count(view)) == [(5,)]


def test_full_staging_schema(spark):
    """With all source columns present, staging is strict and keeps every one."""
    for table, names in tpch.STAGING.items():
        raw = spark.createDataFrame([tuple(range(len(names)))], ", ".join(f"{n} int" for n in names))
        assert tpch.stage(raw, table, strict=True).columns == list(names.values())


def test_full_customer_geo_and_orders(spark):
    def frame(table):
        names = tpch.STAGING[table]
        return tpch.stage(spark.createDataFrame([(1,) * len(names)], ", ".join(f"{n} int" for n in names)), table, True)

    geo = tpch.customer_geo(frame("customer"), frame("nation"), frame("region"))
    assert geo.columns == [
        "customer_id", "customer_name", "customer_address", "account_balance", "market_segment", "nation_id", "nation_name",
        "region_id", "region_name",
    ]
    fact = tpch.orders_fact(frame("orders"), geo)
    assert {"order_clerk", "ship_priority", "region_name", "market_segment"} <= set(fact.columns) and fact.count() == 1


def test_customers_without_orders_show_zero(spark, rows):
    geo = spark.createDataFrame([(1, "a", "r", "m"), (2, "b", "r", "m")], "customer_id int, customer_name string, region_name string, market_segment string")
    orders = spark.createDataFrame([(1, 5), (1, 6), (9, 1)], "customer_id int, order_total int")
    assert rows(tpch.customer_revenue(orders, geo), "customer_id", "revenue_total", "order_count") == [(1, 11, 2), (2, 0, 0)]


def test_unknown_customers_stay_in_the_priority_summary(spark, rows):
    geo = spark.createDataFrame([(1, "EU", "m")], "customer_id int, region_name string, market_segment string")
    orders = spark.createDataFrame([(1, "HIGH", 5), (1, "HIGH", 6), (9, "HIGH", 1), (None, "LOW", 2)], "customer_id int, order_priority string, order_total int")
    assert rows(tpch.order_priorities_summary(orders, geo)) == [
        ("EU", "m", "HIGH", 2, 11), (None, None, "HIGH", 1, 1), (None, None, "LOW", 1, 2),
    ]


def test_an_ordered_build_computes_its_rows_once(spark, tmp_path):
    """Curve, range bounds and build read stored rows: a job that counts its rows sees each once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id", "id % 37 AS a", "id % 91 AS b").mapInArrow(count, "id long, a long, b long")
    out = sinks.publish_table(df, "counted_build", str(tmp_path / "t"), spread=["id"], cluster=["a", "b"], files=8)
    assert out.count() == 1000 and seen.value == 1000


def test_curve_places_interleave_the_bits_of_both_range_numbers(spark):
    df = spark.range(64).selectExpr("id AS a", "63 - id AS b").unionByName(spark.createDataFrame([(None, 0)], "a long, b long"))
    got = {(r["a"], r["b"]): r["p"] for r in df.withColumn("p", sinks.curve_position(df, ["a", "b"])).collect()}
    cuts = {c: sorted(set(df.agg(F.percentile_approx(c, F.array(*[F.lit(i / 64) for i in range(1, 64)]), 10_000)).first()[0])) for c in ("a", "b")}
    for (a, b), place in got.items():
        at = [sum(c < v for c in cuts[n]) if v is not None else 0 for n, v in (("a", a), ("b", b))]
        assert place == sum((at[k] >> bit & 1) << (2 * bit + k) for bit in range(6) for k in range(2))
