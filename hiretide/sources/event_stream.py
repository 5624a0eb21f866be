"""Streams of raw events: a Kafka topic, or a folder of JSON-lines files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KafkaTopic:
    """A topic to read from or write to.

    Reads start with the first event kept and stop with an error where events
    were lost; ``options`` override both and take any other connector option.
    """

    bootstrap: str
    topic: str = "job_postings_raw"
    max_per_batch: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, env: Mapping[str, str], **more) -> KafkaTopic:
        return cls(env["KAFKA_BOOTSTRAP"],
                   env.get("KAFKA_TOPIC_RAW", cls.topic), **more)

    def read_options(self) -> dict[str, str]:
        opts = {"kafka.bootstrap.servers": self.bootstrap, "subscribe": self.topic,
                "startingOffsets": "earliest", "failOnDataLoss": "true"}
        if self.max_per_batch:
            opts["maxOffsetsPerTrigger"] = str(self.max_per_batch)
        return {**opts, **self.options}

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap, "topic": self.topic,
                "kafka.enable.idempotence": "true", "kafka.acks": "all", **self.options}


@dataclass(frozen=True)
class EventFiles:
    """A folder of JSON-lines files, one event per line."""

    path: str
    files_per_batch: int | None = None


def read_event_stream(spark: SparkSession, source: KafkaTopic | EventFiles) -> DataFrame:
    """Raw events with at least a ``value`` column."""
    if isinstance(source, KafkaTopic):
        return spark.readStream.format("kafka").options(**source.read_options()).load()
    reader = spark.readStream
    if source.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", source.files_per_batch)
    return reader.text(source.path)
