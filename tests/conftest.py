"""Shared Spark session for the tests: local, few shuffle partitions, no UI.

The tests are the one place that sets ``spark.checkpoint.dir`` itself (a pytest scratch
folder); library code only reads it from the session.
"""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    session = (
        SparkSession.builder.master("local[4]")
        .appName("sparkloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(ckpt)
    yield session
    session.stop()
