import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from dealreports.functions.attributes import flatten  # noqa: E402
from dealreports.plans.workbooks import ALL_ATTRIBUTES  # noqa: E402
from dealreports.session import local_session  # noqa: E402
from dealreports.sources.tables import PROPERTIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def properties(spark):
    return lambda records: spark.createDataFrame(records, PROPERTIES)


@pytest.fixture(scope="session")
def flat_of(properties):
    return lambda records: flatten(properties(records), ALL_ATTRIBUTES).cache()
