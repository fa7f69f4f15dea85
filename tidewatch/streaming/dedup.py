"""Deduplication of a stream of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedup_stream(events: DataFrame, keys: Sequence[str] = ("server_id", "event_id"),
                 at: str = "received_at", delay: str = "1 minute") -> DataFrame:
    """First copy of each event id; ids are forgotten once the watermark is past them."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))
