import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kardex.session import build_session

    s = build_session("local[*]", app_name="kardex-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
