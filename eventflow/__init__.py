"""eventflow: clickstream analytics as composable Spark DataFrame operators.

Layout
------
``sources``    readers: raw CSV, result folders, raw archive, Kafka, envelope replay
``functions``  column-level helpers (time conversion, message codec, text labels)
``operators``  ``DataFrame -> DataFrame`` insights, window metric, live metrics, funnel
``sinks``      batch writers (CSV snapshot, parquet, Kafka)
``streaming``  Structured Streaming queries over the same operators
``plans``      whole jobs: the batch job and the dashboard data set
"""

from eventflow.session import build_spark, scratch_path

__all__ = ["build_spark", "scratch_path"]
