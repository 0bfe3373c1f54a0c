"""Structured Streaming entry points.

The reference has no streams; its only incremental step is scoring newly
written scenario files with saved models. ``scoring.score_files`` does that
with a file-source stream and a fitted ``PipelineModel``.
"""
