import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="eventide-tests")
    yield s
    s.stop()


def series(spark, groups, vtype="bigint"):
    """{key: [v0, v1, ...]} -> DataFrame(k, pos, v): one reference array per key."""
    rows = [(k, i, v) for k, vals in groups.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, f"k string, pos bigint, v {vtype}")


def by_key(df, col):
    return {r["k"]: r[col] for r in df.collect()}
