"""Nested documents in, flat typed tables out, on Spark."""

from .session import build_session, durable, fresh_dir

__version__ = "0.1.0"
