import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = os.environ.get("NIMBUS_SF_SMALL", "/root/testdata/sf0.001")
SF_MID = os.environ.get("NIMBUS_SF_MID", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from nimbus.session import get_spark

    s = get_spark("local[4]", app_name="nimbus-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_mid():
    return SF_MID


@pytest.fixture()
def scratch(spark):
    from nimbus.session import scratch_path

    p = scratch_path(spark, "test")
    # tests also write with plain Python, which needs a local path, not a file: URI
    return p[len("file:"):] if p.startswith("file:") else p
