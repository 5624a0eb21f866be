"""Publish events, keyed by event id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hiretide.sources.event_stream import EventFiles, KafkaTopic


def publish(events: DataFrame, target: KafkaTopic | EventFiles, checkpoint: str | None = None,
            trigger: dict | None = None) -> StreamingQuery | None:
    """Write ``key``/``value`` events to a topic, or append them to a folder as lines of text.

    A batch frame is written before this returns and a failed delivery fails the write; a streaming
    frame needs a checkpoint and gives the running query.
    """
    if isinstance(target, KafkaTopic):
        columns, kind, options = ["key", "value"], "kafka", target.write_options()
    else:
        columns, kind, options = ["value"], "text", {"path": target.path}
    rows = events.select(*columns)
    if not rows.isStreaming:
        rows.write.format(kind).mode("append").options(**options).save()
        return None
    if not checkpoint:
        raise ValueError("a streaming publish needs a checkpoint")
    writer = rows.writeStream.format(kind).options(**options) \
        .option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
