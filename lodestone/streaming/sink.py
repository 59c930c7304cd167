"""Streams into a database: every micro-batch goes through the chunked writer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(stream: DataFrame, send: Callable[[DataFrame], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """``send`` is an insert of `lodestone.sources` with its target bound.

    Micro-batches that fail are sent again, so rows arrive at least once.
    """
    writer = stream.writeStream.foreachBatch(lambda batch, _: send(batch)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
