import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from reelhouse.session import local_session

    s = local_session(cores="4,2", shuffle_partitions=8)   # one task retry allowed
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def json_rows(spark, docs, column="value"):
    """DataFrame of JSON text lines (one document per row)."""
    return spark.createDataFrame([(json.dumps(d),) for d in docs], [column])
