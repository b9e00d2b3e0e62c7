import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from arspark.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def domain(spark):
    from arspark.sources import Domain, load_tables
    return Domain.of(load_tables(spark, SF_SMALL))


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="arspark-test-")
