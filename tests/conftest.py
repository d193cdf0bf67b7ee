import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardmill.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "cardmill-tests", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    # Test tables are tiny and every plan is new: compiling stages would take most of the time.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    return session
