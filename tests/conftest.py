import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridgeline.session import get_session  # noqa: E402
from stamps import at  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def hourly_of(spark):
    """Rows (point, time, value) as an hourly table with one measure ``t``."""

    def build(rows, fxx=1):
        data = [(p, fxx, at(t) if isinstance(t, str) else t, None if v is None else float(v)) for p, t, v in rows]
        df = spark.createDataFrame(data, "point_id bigint, fxx int, time timestamp_ntz, t double")
        return df.selectExpr("*", "time + make_dt_interval(0, fxx) as valid_time")

    return build
