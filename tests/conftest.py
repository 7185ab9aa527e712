import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    return session()


@pytest.fixture(scope="session")
def inputs(spark):
    from checks.registry import Inputs

    return Inputs(spark, SMALL)
