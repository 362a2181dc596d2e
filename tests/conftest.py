import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the library wherever the tests are started
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

from candlewick.session import local_session  # noqa: E402
from helpers import BAR_SCHEMA  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, shuffle_partitions=8, app="candlewick-tests")
    s.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('tables')}")
    yield s


@pytest.fixture
def make_bars(spark):
    def _make(rows, schema=BAR_SCHEMA):
        return spark.createDataFrame(rows, schema)
    return _make
