"""Incremental forms of the merge on Structured Streaming."""
