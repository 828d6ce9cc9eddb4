"""Kafka sink (needs the ``spark-sql-kafka-0-10`` package on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def kafka_sink_options(bootstrap: str, topic: str, acks: str = "all", linger_ms: int = 50, **extra: str) -> dict[str, str]:
    """Producer settings: every replica acknowledges, 50 ms batching."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.linger.ms": str(linger_ms),
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_kafka(envelopes: DataFrame, bootstrap: str, topic: str, **options: str) -> None:
    """Publish ``(key, value)`` records in one batch job."""
    (
        envelopes.select("key", "value")
        .write.format("kafka")
        .options(**kafka_sink_options(bootstrap, topic, **options))
        .save()
    )
