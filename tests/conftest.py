import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tvpulse.session import checkpoint_dir, get_session
    s = get_session("local[*]", 8)
    # the session's spark.checkpoint.dir is used when the environment names
    # one; checkpoint_dir() creates a scratch folder only when it is unset
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def scratch(spark):
    from tvpulse.session import output_dir
    return f"{output_dir(spark)}/tests-{uuid.uuid4().hex[:8]}"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
