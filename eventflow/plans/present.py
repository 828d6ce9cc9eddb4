"""Presentation of results for comparison with other engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventflow.functions.time import instant_to_utc


def utc_wall_clock(df: DataFrame) -> DataFrame:
    """Instants -> UTC ``timestamp_ntz`` so that collected values do not depend on
    the session or the Python process time zone."""
    return df.select(
        *[
            instant_to_utc(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else df[f.name]
            for f in df.schema.fields
        ]
    )
