import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="postlens-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_text(df) -> str:
    """Physical plan after AQE re-planning (runs the query)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
