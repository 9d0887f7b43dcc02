"""Incremental ingest."""

from ridgeline.streaming.ingest import (  # noqa: F401
    compact_days, day_table, ingest_available, read_stream, repair_days, resume_point, start_ingest, store_days, stored_rows, within_delay,
)
from ridgeline.streaming.gaps import gaps_available, state_store, stream_missing_hours  # noqa: F401
