"""Starting streams."""

from __future__ import annotations

from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming import StreamingQuery


def start(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> StreamingQuery:
    """Start at a fixed interval, or (``None``) process all available data and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
