import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from martmill.operators.incremental import PeriodTable
from martmill.streaming import feed

SCHEMA = "k int, n int, d date"


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")

    def add(*data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)

    return add, stream


def fresh():
    return f"fed_{uuid.uuid4().hex}"


JAN, FEB, MAR = (dt.date(2024, m, 3) for m in (1, 2, 3))


def test_upsert_by_period(spark, tmp_path, source, rows):
    add, stream = source
    table = PeriodTable(spark, fresh(), "m", ["k"])
    with_month = lambda: stream().withColumn("m", F.trunc("d", "month"))
    add((1, 1, JAN), (2, 1, FEB))
    feed.feed_periods(with_month(), table, ["n"], str(tmp_path / "cp"))
    add((2, 3, MAR), (2, 2, FEB))
    add((3, 1, JAN))
    feed.feed_periods(with_month(), table, ["n"], str(tmp_path / "cp"))
    assert rows(table.read(), "k", "n", "d") == [(1, 1, JAN), (2, 3, MAR), (3, 1, JAN)]
    assert table.periods() == ["2024-01-01", "2024-03-01"]


def test_replace_whole_periods(spark, tmp_path, source, rows):
    add, stream = source
    table = PeriodTable(spark, fresh(), "d", ["k"])
    for data in ([(1, 1, JAN), (2, 1, FEB), (3, 1, MAR)], [(7, 1, JAN), (8, 1, MAR)]):
        add(*data)
        feed.feed_replace(stream(), table, str(tmp_path / "cp"))
    assert rows(table.read(), "k") == [(2,), (7,), (8,)]


def test_append_once(spark, tmp_path, source, rows):
    """Two streams into one table; a batch that is delivered again takes its own place."""
    add, stream = source
    name = fresh()
    add((1, 1, JAN))
    feed.feed_append(stream(), name, "batch", str(tmp_path / "a"), "a")
    feed.feed_append(stream(), name, "batch", str(tmp_path / "b"), "b")
    add((2, 1, FEB))
    feed.feed_append(stream(), name, "batch", str(tmp_path / "a"), "a")
    assert rows(spark.table(name), "k", "stream", "batch") == [(1, "a", 0), (1, "b", 0), (2, "a", 1)]
    (tmp_path / "a" / "commits" / "1").unlink()  # the batch was written, but the stream did not get to note it
    (tmp_path / "a" / "commits" / ".1.crc").unlink(missing_ok=True)
    feed.feed_append(stream(), name, "batch", str(tmp_path / "a"), "a")
    assert rows(spark.table(name), "k", "stream", "batch") == [(1, "a", 0), (1, "b", 0), (2, "a", 1)]
    feed.forget_stream(spark.table(name), name, "a")
    feed.feed_append(stream(), name, "batch", str(tmp_path / "new"), "a")
    assert rows(spark.table(name), "k", "stream") == [(1, "a"), (1, "b"), (2, "a")]


def test_rows_without_a_key_pass(spark, tmp_path, source, rows):
    add, stream = source
    table = PeriodTable(spark, fresh(), "m", ["k"])
    add((None, 1, JAN), (None, 2, JAN), (1, 1, JAN), (1, 2, JAN))
    for _ in range(2):  # the second time nothing is new
        feed.feed_periods(stream().withColumn("m", F.trunc("d", "month")), table, ["n"], str(tmp_path / "c1"))
    assert rows(table.read(), "k", "n") == [(1, 2), (None, 1), (None, 2)]
