import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tessera.session import get_session

    folder = tmp_path_factory.mktemp("shared")
    return get_session(4, 4, **{"spark__sql__warehouse__dir": str(folder / "warehouse"), "spark__checkpoint__dir": f"file://{folder}/checkpoint"})


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return SF
