import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from paperloom.runtime import local_session

    return local_session(4, shuffle_partitions=4)


SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SMALL), reason="no test data")
