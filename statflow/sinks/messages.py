"""Keyed JSON messages to a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame


def send_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.compression.type": "gzip",
        "topic": topic,
    }


def send(messages: DataFrame, servers: str, topic: str) -> None:
    """Writes columns ``key`` and ``value``; needs the Kafka connector on the class path."""
    messages.write.format("kafka").options(**send_options(servers, topic)).save()
