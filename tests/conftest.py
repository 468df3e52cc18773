import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from quillmesh.session import session

    s = session(4, shuffle_partitions=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    return s
