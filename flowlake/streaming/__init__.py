"""Incremental models as Structured Streaming jobs."""

from flowlake.streaming.incremental import stream_tx_per_block

__all__ = ["stream_tx_per_block"]
