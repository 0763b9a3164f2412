import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from taxaloom.session import local_session

    session = local_session(cores=8, partitions=2)
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a Column function on a list of inputs: ``values(fn, [..]) -> [..]``."""
    from pyspark.sql import functions as F

    def run(fn, rows, schema="a string"):
        df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + schema)
        cols = [F.col(c) for c in df.columns[1:]]
        out = df.select("i", fn(*cols).alias("v")).orderBy("i").collect()
        return [r.v.asDict() if hasattr(r.v, "asDict") else r.v for r in out]

    return run
