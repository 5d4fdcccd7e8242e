"""Governed-data operators for Spark DataFrames and Structured Streaming."""

from tablewarden.context import Caller, Env, SyncSpec

__all__ = ["Caller", "Env", "SyncSpec"]
