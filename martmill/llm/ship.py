"""The package's own code for the Python workers of a session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import martmill

_shipped: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Sends the package to all executors, once a session, so that their Python workers find it wherever they run."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = os.path.dirname(os.path.dirname(os.path.abspath(martmill.__file__)))
        into = tempfile.mkdtemp(prefix="martmill-code-")
        package = os.path.join(into, "src")
        shutil.copytree(os.path.join(root, "martmill"), os.path.join(package, "martmill"), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(into, "martmill"), "zip", package))
    return spark
