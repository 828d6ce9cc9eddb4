import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventflow.session import build_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_spark(
        "eventflow-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def la_zone(spark):
    """Run a test with a session zone far from UTC; results must not change."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    yield
    spark.conf.set("spark.sql.session.timeZone", old)


def raw_rows(spark, rows):
    from eventflow.schemas import RAW_SCHEMA

    return spark.createDataFrame(rows, RAW_SCHEMA)


def metric_rows(spark, rows):
    """rows: (window_start text 'YYYY-MM-DD HH:MM', event, count)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "ws string, event string, event_count long")
    start = F.to_timestamp(F.concat(F.col("ws"), F.lit(":00Z")))
    return df.select(
        start.alias("window_start"),
        (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
        "event",
        "event_count",
    )
