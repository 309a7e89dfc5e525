import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from notecohort.session import build_session

    ckpt = tempfile.mkdtemp(prefix="notecohort-test-ckpt-")
    spark = build_session("local[4]", app="notecohort-tests", shuffle_partitions=8,
                          conf={"spark.checkpoint.dir": ckpt})
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="notecohort-test-")
