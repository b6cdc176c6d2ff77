from __future__ import annotations

import logging
import tempfile

import pytest
from pyspark.sql import SparkSession

from tickloom.session import build_session

TESTDATA = "/root/testdata"


def make_session() -> SparkSession:
    spark = build_session(
        "tickloom-tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tickloom-warehouse-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    logging.getLogger("py4j").setLevel(logging.ERROR)
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
