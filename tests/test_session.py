import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martmill import session as S


class FakeSession:
    """A session on a cluster or a local one, with or without a shared folder."""

    def __init__(self, master, folder):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(FakeSession("yarn", None))
    assert S.shared_dir(FakeSession("yarn", "hdfs://x/y/")) == "hdfs://x/y"


def test_a_local_session_may_use_a_temporary_one():
    fake = FakeSession("local[2]", None)
    assert S.shared_dir(fake) == S.shared_dir(fake)
    assert os.path.isdir(S.shared_dir(fake))


def test_tune_sets_what_plans_rely_on(spark):
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    S.tune(spark)
    assert all(spark.conf.get(k) == v for k, v in S.RUNTIME_CONF.items())


def test_tune_bounds_what_a_task_reads_and_keeps_smaller_settings(spark):
    before = spark.conf.get(S.ADVISORY_CONF)
    try:
        for given, want in (("64m", f"{S.ADVISORY_BYTES}b"), ("67108864b", f"{S.ADVISORY_BYTES}b"), ("16k", "16k"), ("8m", "8m")):
            spark.conf.set(S.ADVISORY_CONF, given)
            S.tune(spark)
            assert spark.conf.get(S.ADVISORY_CONF) == want
    finally:
        spark.conf.set(S.ADVISORY_CONF, before)


def test_counted_write(spark):
    path = S.scratch_path(spark, "counted")
    got = S.write_counted(spark.range(10), path, n=F.count(F.lit(1)), top=F.max("id"))
    assert got == {"n": 10, "top": 9} and spark.read.parquet(path).count() == 10
    assert S.write_counted(spark.range(0), S.scratch_path(spark, "none"), top=F.max("id")) == {"top": None}


def test_python_workers_get_texts_in_bounded_batches(spark):
    """Ten thousand long rows are not one batch."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = S.tune(spark).range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("t"))
    got = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
    assert len(got) > 1 and sum(got) >= 20_000_000 and max(got) <= 2 * S.BATCH_BYTES
