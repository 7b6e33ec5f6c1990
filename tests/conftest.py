import pytest

from siftmill.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("4", 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s
