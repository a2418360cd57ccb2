"""Structured Streaming forms of the pipeline."""

from feedline.streaming.stream import dedup_stream, feed_batch_writer, ingest_available, run_available

__all__ = ["dedup_stream", "feed_batch_writer", "ingest_available", "run_available"]
