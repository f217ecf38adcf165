"""Parts of aggregates against plain groupings; deltas that come twice or stop half-way."""

import random

import pytest
from pyspark.sql import functions as F

from martmill.operators import partials as P

ROLLUP = P.Rollup(["k", "t"], sums={"s": "v", "n": "1"}, maxima={"m": "v"}, distinct={"ids": "id", "names": "concat('n', id % 7)"})


def frame(spark, n=4000, seed=1):
    r = random.Random(seed)
    rows = [(None if i % 11 == 0 else 0 if i % 3 == 0 else i % 13, "xy"[i % 2], None if i % 5 == 0 else r.randint(-50, 50), None if i % 17 == 0 else r.choice([r.randint(-200, 200), -(2**63), 2**63 - 1, r.randint(0, 10**12)])) for i in range(n)]
    return spark.createDataFrame(rows, "k int, t string, v int, id bigint").repartition(5)


def plain(df, *keys):
    return df.groupBy(*keys).agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.max("v").alias("m"), F.countDistinct("id").alias("ids"), F.countDistinct(F.expr("concat('n', id % 7)")).alias("names"))


def test_parts_add_up(spark, rows):
    df = frame(spark)
    pieces = df.randomSplit([1.0, 2.0, 1.0], seed=4)
    whole = ROLLUP.merged(*[ROLLUP.parts(p) for p in pieces])
    assert rows(ROLLUP.finished(whole)) == rows(plain(df, "k", "t"))
    assert rows(ROLLUP.finished(ROLLUP.parts(df.limit(0)))) == []


def test_several_groupings(spark, rows):
    df = frame(spark)
    got = ROLLUP.at_sets(ROLLUP.parts(df), {"both": {"k": F.col("k"), "t": F.col("t")}, "parity": {"k": F.col("k") % 2}, "all": {}})
    none, both = F.lit(None), plain(df, "k", "t").select(F.lit("both"), "k", "t", "s", "n", "m", "ids", "names")
    parity = plain(df.withColumn("k", F.col("k") % 2), "k").select(F.lit("parity"), "k", none.cast("string"), "s", "n", "m", "ids", "names")
    everything = plain(df).select(F.lit("all"), none.cast("int"), none.cast("string"), "s", "n", "m", "ids", "names")
    assert rows(got) == rows(both.union(parity).union(everything))


def test_deltas_touch_only_their_slots(spark, rows, tmp_path):
    path = str(tmp_path / "parts")
    assert P.stored_parts(spark, path) is None
    df, more = frame(spark), frame(spark, 60, seed=9).where("k = 4")
    P.apply_delta(spark, path, ROLLUP, df, 1, slots=16)
    before = {f.name: {x.name for x in f.iterdir()} for f in (tmp_path / "parts").iterdir() if f.is_dir()}
    P.apply_delta(spark, path, ROLLUP, more, 2, slots=16)
    after = {f.name: {x.name for x in f.iterdir()} for f in (tmp_path / "parts").iterdir() if f.is_dir()}
    assert 0 < sum(before[s] != after[s] for s in before) <= 2  # the groups (4, x) and (4, y)
    assert rows(ROLLUP.finished(P.stored_parts(spark, path))) == rows(plain(df.union(more), "k", "t"))
    P.apply_delta(spark, path, ROLLUP, more, 2, slots=16)  # again: nothing is added twice
    P.apply_delta(spark, path, ROLLUP, more.limit(0), 3, slots=16)
    assert rows(ROLLUP.finished(P.stored_parts(spark, path))) == rows(plain(df.union(more), "k", "t"))


def test_a_load_that_stopped_half_way_is_completed(spark, rows, tmp_path):
    path, df, more = str(tmp_path / "parts"), frame(spark), frame(spark, 900, seed=9)
    P.apply_delta(spark, path, ROLLUP, df, 1, slots=8)
    old = {f.name: f for f in (tmp_path / "parts").iterdir() if f.is_dir()}
    saved = {name: [(x.name, x.read_bytes()) for x in f.iterdir()] for name, f in old.items()}
    P.apply_delta(spark, path, ROLLUP, more, 2, slots=8)
    for name in list(saved)[: len(saved) // 2]:  # as if these slots had not been written any more
        for x in old[name].iterdir():
            x.unlink()
        for file, data in saved[name]:
            (old[name] / file).write_bytes(data)
    spark.catalog.clearCache()
    P.apply_delta(spark, path, ROLLUP, more, 2, slots=8)
    assert rows(ROLLUP.finished(P.stored_parts(spark, path))) == rows(plain(df.union(more), "k", "t"))


def test_an_unknown_expression_fails(spark):
    with pytest.raises(Exception, match="nope"):
        P.Rollup(["k"], sums={"s": "nope"}).parts(frame(spark, 5))


def test_a_repeated_delta_computes_no_parts(spark, tmp_path, monkeypatch):
    """A batch that every slot has taken is told by its keys; one half of whose slots are new is completed."""
    rollup = P.Rollup(["k"], sums={"s": "v"}, distinct={"n": "id"})
    delta = spark.range(100).selectExpr("id % 10 AS k", "id AS v", "id")
    path = str(tmp_path / "parts")
    P.apply_delta(spark, path, rollup, delta.where("k < 5"), 1, slots=4)
    P.apply_delta(spark, path, rollup, delta, 2, slots=4)
    want = sorted((k, sum(v for v in range(100) if v % 10 == k) * (2 if k < 5 else 1), 10) for k in range(10))
    assert sorted(tuple(r) for r in rollup.finished(P.stored_parts(spark, path)).collect()) == want

    def never(self, df):
        raise AssertionError("parts of a batch already taken")

    monkeypatch.setattr(P.Rollup, "parts", never)
    P.apply_delta(spark, path, rollup, delta, 2, slots=4)
    assert sorted(tuple(r) for r in rollup.finished(P.stored_parts(spark, path)).collect()) == want
