"""Streaming: the line ingest applied to arriving files.

The reports have no streaming semantics of their own (no windows, watermarks
or late data); what carries over is ingest: new rating, movie or user files
landing in a folder are parsed with the same expressions as in batch and
appended exactly once. The aggregates of :mod:`marquee.operators` are plain
``groupBy`` plans and also run on a streaming frame (update/complete mode).
"""

from marquee.streaming.ingest import read_ingested, start_ingest, stream_lines

__all__ = ["read_ingested", "start_ingest", "stream_lines"]
