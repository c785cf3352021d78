import os

import pytest

from trafficloom.session import build_session

SF_SMALL = "/root/testdata/sf0.001"
SF_TEST = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "trafficloom-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__sql__shuffle__partitions="2",
        spark__default__parallelism="2",
        spark__driver__memory="4g",
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1 -XX:+UseParallelGC",
        spark__sql__warehouse__dir=str(scratch / "warehouse"),
        spark__checkpoint__dir=str(scratch / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
