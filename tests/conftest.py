import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=3)
    yield session
    session.stop()


@pytest.fixture
def make_posts(spark):
    """Posts from `(time, text)` pairs; times are `yyyy-MM-dd HH:mm:ss`, or seconds of 2024-01-01."""

    def build(rows):
        def time_of(t):
            return t if isinstance(t, str) else f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}"

        data = [(i, time_of(t), "fr", text) for i, (t, text) in enumerate(rows)]
        frame = spark.createDataFrame(data, "post_id BIGINT, ts STRING, lang STRING, text STRING")
        return frame.withColumn("ts", frame.ts.cast("timestamp_ntz"))

    return build


@pytest.fixture(scope="session")
def sf_dir():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    return folder
