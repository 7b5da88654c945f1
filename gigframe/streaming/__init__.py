"""Structured Streaming ingest."""

from .resume import replay_setlists_twice, run_incremental

__all__ = ["replay_setlists_twice", "run_incremental"]
