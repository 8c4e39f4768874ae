"""Structured Streaming jobs: bronze ingest and the SCD-1 stream."""

from finlake.streaming.bronze import run_bronze  # noqa: F401
from finlake.streaming.scd1 import Scd1Table  # noqa: F401
