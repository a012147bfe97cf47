"""Tidemark: growing tables read incrementally, as batches or as streams, on Spark."""

from tidemark.operators.profile import offset_order_profile, offset_profile
from tidemark.plans.workspace import scratch
from tidemark.sources.bounds_index import BoundsIndex
from tidemark.sources.jdbc import JdbcTable
from tidemark.sources.tables import FrameTable, ParquetTable
from tidemark.streaming.datasource import drain_stream, read_stream, register
from tidemark.streaming.feed import IncrementalFeed
from tidemark.streaming.landing import LandedStream
from tidemark.streaming.offset_log import read_spans
from tidemark.streaming.sinks import committed_sink, late_rows, parquet_sink, read_committed

__all__ = [
    "BoundsIndex",
    "FrameTable",
    "IncrementalFeed",
    "JdbcTable",
    "LandedStream",
    "ParquetTable",
    "committed_sink",
    "drain_stream",
    "late_rows",
    "offset_order_profile",
    "offset_profile",
    "parquet_sink",
    "read_committed",
    "read_spans",
    "read_stream",
    "register",
    "scratch",
]
