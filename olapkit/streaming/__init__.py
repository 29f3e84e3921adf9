"""Incremental (Structured Streaming) forms of the lake loads.

The reference has no stream processing: no stream source, trigger,
watermark or state. The only streaming piece here is the incremental form of
its lake load (JSON logs in, parquet out), so that newly arriving log files
are loaded exactly once and a restarted job resumes from its checkpoint.
"""

from .ingest import incremental_load

__all__ = ["incremental_load"]
