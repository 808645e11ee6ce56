"""Streaming variants of the stateless log operators."""

from .logs import log_stream, read_log_stream, start_log_sink, start_views

__all__ = ["log_stream", "read_log_stream", "start_log_sink", "start_views"]
