from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from airq.session import build_session

    s = build_session("tests", "local[8]", 4, "8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows with timestamps given as text in columns named ``*time``."""
    from pyspark.sql import functions as F

    def make(rows, ddl):
        text = ", ".join(f"{c.strip().split(' ')[0]} {'string' if c.strip().split(' ')[1] == 'timestamp' else c.strip().split(' ')[1]}" for c in ddl.split(","))
        df = spark.createDataFrame(rows, text)
        for c in ddl.split(","):
            n, t = c.strip().split(" ")
            if t == "timestamp":
                df = df.withColumn(n, F.col(n).cast("timestamp"))
        return df

    return make
