import pytest
from pyspark.sql import functions as F

from martmill.operators import aggregates as A
from martmill.operators import joins as J
from martmill.operators import setops as S


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k int")


@pytest.mark.parametrize(
    "target, exists_rule, not_in_rule",
    [
        ([], [1, 2, None], [1, 2, None]),
        ([1], [2, None], [2]),
        ([1, None], [2, None], []),
    ],
)
def test_anti_key_follows_both_rules(spark, target, exists_rule, not_in_rule):
    delta, known = keys(spark, 1, 2, None), keys(spark, *target)
    got = [r[0] for r in J.anti_key(delta, known, "k").collect()]
    assert sorted(got, key=repr) == sorted(exists_rule, key=repr)
    got = [r[0] for r in J.anti_key(delta, known, "k", null_blocks=True).collect()]
    assert sorted(got, key=repr) == sorted(not_in_rule, key=repr)
    delta.createOrReplaceTempView("delta_keys")
    known.createOrReplaceTempView("known_keys")
    literal = spark.sql("SELECT k FROM delta_keys WHERE k NOT IN (SELECT k FROM known_keys)").collect()
    assert sorted(got, key=repr) == sorted((r[0] for r in literal), key=repr)


def test_preaggregation_does_not_fan_out(spark, rows):
    left = keys(spark, 1, 2, None)
    many = spark.createDataFrame([(1, 5), (1, 7), (None, 9)], "k int, v int")
    out = J.join_left_preagg(left, many, "k", [F.sum("v").alias("v")], defaults={"v": 0})
    assert rows(out, "k", "v") == [(1, 12), (2, 0), (None, 0)]


def test_unused_side_is_not_read(spark, tmp_path, rows):
    path = str(tmp_path / "dim")
    keys(spark, 1, 1, 2).write.parquet(path)
    left = keys(spark, 1, 1, 3)
    out = J.join_unused_side(left, spark.read.parquet(path), "k")
    assert rows(out) == [(1,), (1,), (3,)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "parquet" not in plan


def test_orphans_and_members(spark, rows):
    child, parent = keys(spark, 1, 2, None), keys(spark, 2, None).withColumnRenamed("k", "p")
    assert rows(J.anti_orphans(child, "k", parent, "p")) == [(1,)]
    assert rows(J.semi_members(child, "k", parent, "p")) == [(2,)]


def test_above_max_of_an_empty_target_is_nothing(spark, rows):
    df = keys(spark, 1, 2, 3)
    assert rows(J.filter_above_max(df, "k", keys(spark, 1, 2))) == [(3,)]
    assert rows(J.filter_above_max(df, "k", keys(spark))) == []


def test_full_join_matches_null_keys(spark, rows):
    left = spark.createDataFrame([(1, 10), (None, 20)], "k int, a int")
    right = spark.createDataFrame([(None, 5), (2, 6)], "k int, b int")
    assert rows(J.join_full(left, right, "k")) == [(1, 10, None), (2, None, 6), (None, 20, 5)]


def test_null_keys_form_a_group(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(A.count_and_sum(df, ["k"], "v", "t", "n")) == [("a", 1, 3), (None, 2, 3)]


def test_conditional_sum_counts_misses_as_zero(spark):
    df = spark.createDataFrame([(True, 1), (False, 2), (None, 4)], "c boolean, v int")
    assert df.agg(A.conditional_sum(F.col("c"), "v")).first()[0] == 1


def test_pairs_to_map_takes_repeated_names(spark, rows):
    df = spark.createDataFrame([("t", "b", "1"), ("t", "a", "2"), ("t", "a", "3"), ("u", "c", None)], "k string, n string, v string")
    assert rows(A.pairs_to_map(df, ["k"], "n", "v", "m")) == [("t", '{"a":"3","b":"1"}'), ("u", '{"c":null}')] or rows(
        A.pairs_to_map(df, ["k"], "n", "v", "m")
    ) == [("t", '{"a":"3","b":"1"}'), ("u", "{}")]


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (1, 3, "z"), (2, None, "n")], "k int, v int, c string")
    assert rows(A.latest_per_key(df, ["k"], ["v"])) == [(1, 3, "z"), (2, None, "n")]
    with pytest.raises(TypeError):
        A.latest_per_key(df.withColumn("m", F.create_map("c", "c")), ["k"], ["v"])


def test_set_operations(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(None, "y"), (3, "z")], "k int, v string")
    assert rows(S.set_minus(a, b, ["k", "v"])) == [(1, "x")]
    want = spark.createDataFrame([("s", "r1"), ("s", "r2"), ("s", "r2")], "s string, r string")
    have = spark.createDataFrame([("s", "r2"), ("s", "r3")], "s string, r string")
    assert rows(S.set_reconcile(want, have, ["s", "r"], "grant", "revoke")) == [("grant", "s", "r1"), ("revoke", "s", "r3")]


def test_merge_lists(spark, rows):
    df = spark.createDataFrame([("s", ["a", "b"]), ("s", ["b"]), ("t", []), ("u", None)], "s string, roles array<string>")
    assert rows(S.merge_lists_unique(df, "s", "roles", "role")) == [("s", "a"), ("s", "b")]
