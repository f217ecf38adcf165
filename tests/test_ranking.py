import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from martmill.operators import cuts
from martmill.operators import ranking as R
from martmill.plans import jaffle


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 7, 8, 9, 13, 101, 997, 2503])
def test_buckets_equal_quantile_cuts_of_first_ranks(spark, n):
    data = [(i, (i * 7919) % 37) for i in range(n)]
    df = spark.createDataFrame(data, "k int, v int").repartition(8)
    got = dict(R.quantile_bucket(df, "v", "k", "b").select("k", "b").collect())
    down = dict(R.quantile_bucket(df, "v", "k", "b", ascending=False).select("k", "b").collect())
    pdf = pd.DataFrame(data, columns=["k", "v"])
    want = pd.qcut(pdf["v"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert [got[k] for k in pdf["k"]] == want.tolist()
    assert [down[k] for k in pdf["k"]] == (6 - want).tolist()


def test_a_single_row_is_bucket_one(spark):
    df = spark.createDataFrame([(1, 5)], "k int, v int")
    assert R.quantile_bucket(df, "v", "k", "b").first()["b"] == 1


def test_a_hot_value_is_ranked_by_several_tasks(spark):
    n = 20000
    df = spark.range(n).withColumn("v", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with much data
    try:
        placed, before = R._placed(df, ["v", "id"])
        ranked = R.rank_first(df, "v", "id", total="n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = placed.filter("v = 1").select("_slice").distinct().count()
    assert hot > 1
    assert before.count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ranked.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.max("n")).first() == (1, n, n, n)
    order = [r["id"] for r in ranked.orderBy("rank").collect()]
    expected = sorted(range(n), key=lambda i: (1 if i % 3 == 0 else i, i))
    assert order == expected


def _lines(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    return spark.createDataFrame(
        [
            ("c1", day(1), "o1", 10), ("c1", day(5), "o2", 5), ("c1", day(5), "o2", 1),
            ("c2", day(9), "o3", None), (None, day(20), "o4", 7),
        ],
        "customer_id string, ordered_at timestamp_ntz, order_id string, product_price int",
    )


def test_rfm_metrics(spark, rows):
    assert rows(R.rfm_metrics(_lines(spark))) == [("c1", 15, 2, 16), ("c2", 11, 1, 0)]


# Segment by recency score (rows 1 to 5) and frequency score (columns 1 to 5), written out.
SEGMENTS = [
    ["Hibernating", "Hibernating", "Hibernating", "Hibernating", "Hibernating"],
    ["At-Risk", "At-Risk", "At-Risk", "At-Risk", "At-Risk"],
    ["Potential Loyalists", "Potential Loyalists", "Loyal Customers", "Loyal Customers", "Loyal Customers"],
    ["Potential Loyalists", "Potential Loyalists", "Loyal Customers", "Champions", "Champions"],
    ["Potential Loyalists", "Potential Loyalists", "Loyal Customers", "Champions", "Champions"],
]


def test_every_pair_of_scores_has_its_segment(spark):
    """25 customers, one for each pair of scores: recency falls with the first digit, frequency grows with the second."""
    data = [(f"{r}{f}", 10 * (6 - r), f, float(5 * r + f)) for r in range(1, 6) for f in range(1, 6)]
    df = spark.createDataFrame(data, "customer_id string, recency_days int, order_frequency bigint, lifetime_value double")
    got = {x["customer_id"]: x for x in R.rfm_segments(df).collect()}
    for r in range(1, 6):
        for f in range(1, 6):
            assert got[f"{r}{f}"]["customer_segment"] == SEGMENTS[r - 1][f - 1]
            assert got[f"{r}{f}"]["rfm_score"] == f"{r}{f}{r}"  # lifetime value grows with recency first


def test_scores_of_seven_by_hand(spark):
    """Cut points of 7 ranks lie at 2.2, 3.4, 4.6 and 5.8: ranks 1 and 2, 3, 4, 5, 6 and 7. Ties go by customer."""
    data = [("a", 9, 4, 1.0), ("b", 9, 4, 1.0), ("c", 9, 4, 1.0), ("d", 9, 4, 1.0), ("e", 9, 4, 1.0), ("f", 9, 4, 1.0), ("g", 9, 4, 1.0)]
    df = spark.createDataFrame(data, "customer_id string, recency_days int, order_frequency bigint, lifetime_value double")
    got = [x["rfm_score"] for x in R.rfm_segments(df).orderBy("customer_id").collect()]
    assert got == ["511", "511", "422", "333", "244", "155", "155"]


def test_segment_summary_skips_the_customer_table(spark):
    segments = spark.createDataFrame(
        [("a", 3, 2, 10, "Champions"), ("b", 4, 3, 11, "Champions"), ("c", 9, 1, 1, "At-Risk")],
        "customer_id string, recency_days int, order_frequency bigint, lifetime_value int, customer_segment string",
    ).withColumn("lifetime_value", F.col("lifetime_value").cast("decimal(16,2)"))
    customers = spark.createDataFrame([("a",), ("b",)], "customer_id string")
    got = {r["customer_segment"]: tuple(float(x) for x in r[1:]) for r in jaffle.customer_segment_orders(segments, customers).collect()}
    assert got == {"Champions": (2, 10.5, 2.5, 4.0), "At-Risk": (1, 1.0, 1.0, 9.0)}


def test_cuts_of_any_type_are_exact(spark):
    """Every rank asked for is the row a full sort puts there: hot values, NULLs, long common prefixes, floats of all sizes."""
    r = random.Random(12)
    day, moment = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 3)
    rows, keys = [], r.sample([f"{'same long prefix ' * (i % 2)}{i:05d}é"[: 8 + i % 40] + f"-{i}" for i in range(3000)], 3000)
    for i, k in enumerate(keys):
        rows.append((
            k, 7 if i % 3 else r.randint(-(10**18), 10**18), None if i % 5 == 0 else r.choice([0.0, -0.0, float("nan"), float("inf"), -1e300, 1e-300, r.gauss(0, 1)]), Decimal(r.randint(-500, 500)) / 100,
            "x" * (i % 9) + chr(97 + i % 3), day + dt.timedelta(days=i % 11), moment + dt.timedelta(microseconds=r.randint(0, 10**12)), bool(i % 2),
        ))
    df = spark.createDataFrame(rows, "k string, i bigint, d double, m decimal(10,2), s string, t date, z timestamp_ntz, b boolean").repartition(6)
    ranks = sorted({1, 2, 600, 601, 1000, 1500, 2000, 2999, 3000, *(r.randint(1, 3000) for _ in range(20))})
    metrics = ("i", "d", "m", "s", "t", "z", "b")
    got = cuts.cut_rows(df, metrics, lambda n: ranks, "k", bins=7, few=50)
    for m in metrics:
        want = [x["k"] for x in df.orderBy(F.asc_nulls_first(m), "k").select("k").collect()]
        assert [k for _, k in got[m]] == [want[n - 1] for n in ranks], m
    assert cuts.cut_rows(df.limit(0), ["i"], lambda n: [], "k") == {"i": []}
    with pytest.raises(TypeError):
        cuts.cut_rows(df.select("k", F.array("i").alias("a")), ["a"], lambda n: [1], "k")


def test_buckets_need_no_sort(spark):
    df = spark.range(5000).withColumn("v", F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")))
    out = R.quantile_buckets(df, {"v": ("up", True), "id": ("down", False)}, "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    order = [x["id"] for x in out.orderBy("v", "id").collect()]
    want = {k: max(1, -(-(i * 5) // 4999)) for i, k in enumerate(order)}
    got = {x["id"]: (x["up"], x["down"]) for x in out.collect()}
    assert all(got[k] == (want[k], 6 - max(1, -(-(k * 5) // 4999))) for k in got)
    assert R.quantile_buckets(df.limit(0), {"v": ("up", True)}, "id").count() == 0
