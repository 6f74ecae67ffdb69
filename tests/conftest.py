from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumbung.operators.skew import SkewSettings  # noqa: E402
from lumbung.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("checkpoint")
    session = local_session(
        4, "tests", **{"spark.checkpoint.dir": str(base), "spark.sql.shuffle.partitions": "4",
                       "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


#: Examine every input and treat any key with more than 20 rows as heavy.
TINY = SkewSettings(check_bytes=0, group_rows=20, broadcast_bytes=-1, broadcast_rows=0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
