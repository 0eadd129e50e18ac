import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def rows(spark):
    """rows("a int, b string", [(1, "x")]) -> DataFrame"""

    def make(schema, data):
        return spark.createDataFrame(data, schema)

    return make
