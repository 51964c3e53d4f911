import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from affinity.session import build_session, checkpoint_dir
    s = build_session(master="local[4]", shuffle_partitions=8, app="affinity-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def interactions_df(spark, rows):
    from affinity.sources.tables import INTERACTION_SCHEMA
    return spark.createDataFrame(rows, INTERACTION_SCHEMA)
