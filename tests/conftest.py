import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql.types import StructType

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyfold.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            # Plans are read by the tests, so their scans are not abridged.
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """rows(ddl, {...}, {...}): a DataFrame; columns not given are null."""

    def build(ddl, *records):
        schema = StructType.fromDDL(ddl)
        unknown = {k for r in records for k in r} - set(schema.names)
        assert not unknown, unknown
        data = [tuple(r.get(n) for n in schema.names) for r in records]
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture(scope="session")
def values(spark, rows):
    """values(expression builder, inputs): the expression over one text column."""

    def run(build, inputs, ddl="x string"):
        frame = rows("i int, " + ddl, *[{"i": i, "x": x} for i, x in enumerate(inputs)])
        return [r.y for r in frame.select("i", build().alias("y")).orderBy("i").collect()]

    return run


def at(day, hour=0):
    return dt.datetime(2025, 1, day, hour)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
