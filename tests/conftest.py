import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from revmart.session import get_session

    # executors import the package from here (local mode)
    os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
    session = get_session(
        master="local[4]",
        app_name="revmart-tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    # tests only: the checkpoint folder is unset locally, so name one
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revmart-test-ckpt-"))
    yield session
    from revmart.session import remove_scratch

    remove_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf001():
    return os.path.join(TESTDATA, "sf0.001")


@pytest.fixture(scope="session")
def sf01():
    return os.path.join(TESTDATA, "sf0.01")
