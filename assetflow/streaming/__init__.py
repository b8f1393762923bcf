"""Structured Streaming: CSV landing -> bronze -> silver -> gold."""

from .medallion import Medallion, READING_SCHEMA

__all__ = ["Medallion", "READING_SCHEMA"]
