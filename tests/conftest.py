from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from touchline.session import DEBUG_CONF, JIT_OPTIONS, ensure_checkpoint_dir

    session = (
        SparkSession.builder.master("local[*]")
        .appName("touchline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config(DEBUG_CONF, "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="touchline-test-")
