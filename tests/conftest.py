from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.session import build_session, scratch_path  # noqa: E402
from stratalake.sources.tables import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength="2000",
        spark__sql__debug__maxToStringFields="200",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    return Lake(spark, scratch_path(spark, "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_")


@pytest.fixture
def rows(spark):
    """Rows from tuples with a DDL schema."""

    def make(ddl, *data):
        return spark.createDataFrame(list(data), ddl)

    return make


def as_set(df):
    return {tuple(r) for r in df.collect()}


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
