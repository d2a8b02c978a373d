"""Incremental and streaming loads: high-water extracts, AvailableNow file streams, upsert sinks."""
