"""Structured Streaming."""

from .merge_stream import merge_stream, one_per_version
from .spec_stream import export_batch, stream_specs
