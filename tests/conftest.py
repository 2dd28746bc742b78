import pytest

from showgrain.session import build


@pytest.fixture(scope="session")
def spark():
    s = build("showgrain-tests", cpus=4, shuffle=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
