"""Dimension sync: change events to keyed dimension tables, as a config table says."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.parsing import split_changes
from tillstream.sources.sinks import BatchWriter, dimension_batch
from tillstream.streaming.run import start


def sync_batch(config: Callable[[], DataFrame], root: str,
               bad: BatchWriter | None = None) -> BatchWriter:
    """Writer for a micro-batch of raw change texts; unreadable texts go to `bad`."""
    upsert = dimension_batch(config, root)

    def write(text: DataFrame, batch_id: int) -> None:
        good, broken = split_changes(text)
        upsert(good, batch_id)
        if bad:
            bad(broken, batch_id)
    return write


def sync(text: DataFrame, config: Callable[[], DataFrame], root: str, checkpoint: str,
         bad: BatchWriter | None = None, **trigger) -> StreamingQuery:
    return start(text, checkpoint, sync_batch(config, root, bad), **trigger)
