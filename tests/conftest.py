from __future__ import annotations

import sys
import uuid
import warnings
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltstone import Warehouse  # noqa: E402
from siltstone.session import local_session, new_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


def in_step(session) -> bool:
    """Whether the JVM's answer belongs to the question just asked."""
    asked = uuid.uuid4().hex
    try:
        return session._jvm.java.util.Objects.toString(asked) == asked
    except Exception:  # noqa: BLE001 - whatever an answer to another question leads to
        return False


@pytest.fixture(autouse=True)
def answers_in_step(request):
    """A test that was interrupted between a question to the JVM and its answer must not fail all tests after it.

    Where that happened the connection is given up for a new one, and the test that it happened in is named.
    """
    yield
    session = SparkSession._instantiatedSession
    if session is None or session._sc._jsc is None or in_step(session):
        return
    client = session._sc._gateway._gateway_client
    client.thread_connection.connection().socket.close()
    del client.thread_connection.connection
    warnings.warn(f"answers of the JVM were out of step after {request.node.nodeid}", stacklevel=1)
    assert in_step(session)


@pytest.fixture
def wh(spark):
    """An empty warehouse in a folder of its own."""
    return Warehouse(spark, new_folder(spark, "test-warehouse"))


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df):
    """Rows as tuples in a stable order, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])
