import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def facts_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "subject string, predicate string, cat_object string")

    return make


@pytest.fixture()
def types_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "subject string, cat_object string")

    return make
