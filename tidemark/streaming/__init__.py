"""Streaming: intentionally empty.

The pipelines this library rebuilds have no stream source, watermark,
event-time window or stateful operator; the one recurring job, the
incremental load (``tidemark.sources.incremental``), is a bounded batch
driven by a high-water mark. Nothing is invented here.
"""
