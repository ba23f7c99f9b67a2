import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flatproof.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__checkpoint__dir=str(scratch), spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def numbered(spark):
    """Lines of named files as numbered lines; the list order is the order of arrival."""

    def make(**files):
        rows = [
            (name, n, line, sum(map(len, lines)), seq)
            for seq, (name, lines) in enumerate(files.items())
            for n, line in enumerate(lines, 1)
        ]
        df = spark.createDataFrame(rows, "file string, source_row_no bigint, line string, size int, seq int")
        return df.selectExpr(
            "file", "source_row_no", "line", "size", "timestamp_micros(1700000000000000 + seq) as modified"
        )

    return make
