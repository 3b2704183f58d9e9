"""Structured Streaming jobs."""

from footfall.streaming.flow import start_location_flow, stream_location_flow
from footfall.streaming.words import start_batch_word_count, start_running_word_count

__all__ = [
    "start_batch_word_count",
    "start_location_flow",
    "start_running_word_count",
    "stream_location_flow",
]
