import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codesift.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


def one_col(spark, values, col_type="string", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {col_type}")
