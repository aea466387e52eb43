import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from agorakit.session import local_session

    # Test data is tiny: compiling generated code would take most of the time.
    session = local_session(
        cores=8, shuffle_partitions=2, spark__sql__codegen__wholeStage="false", spark__sql__codegen__factoryMode="NO_CODEGEN",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
