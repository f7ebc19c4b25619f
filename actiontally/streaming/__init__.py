"""Structured Streaming jobs: windowed counts into change logs, lake landing, fan-out."""

from actiontally.streaming.jobs import (
    StreamResult, aggregate_stream, closed_window_stream, curate_slots, lake_stream, landing_stream, open_windows,
    run_to_completion, start_aggregates, start_all, start_fan_out, start_landing,
)
from actiontally.streaming.staging import file_stream, replay_slices, stage_slices

__all__ = [
    "StreamResult", "aggregate_stream", "closed_window_stream", "curate_slots", "lake_stream", "landing_stream", "open_windows",
    "run_to_completion", "start_aggregates", "start_all", "start_fan_out", "start_landing", "file_stream", "replay_slices", "stage_slices",
]
