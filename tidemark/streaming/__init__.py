"""Streams of feature rows."""

from tidemark.streaming.expiry import expiring_stream
from tidemark.streaming.latest import drop_retries, latest_stream
from tidemark.streaming.push import push_stream

__all__ = ["drop_retries", "expiring_stream", "latest_stream", "push_stream"]
