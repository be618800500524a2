import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Functions defined in test modules are looked up by name in the workers.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])

from promptframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of a column expression over one text column ``x``."""

    def values(texts, expression):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r[1] for r in sorted(frame.select("i", expression).collect())]

    return values
