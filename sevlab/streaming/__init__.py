"""Structured Streaming use of a fitted preparation (the original pipeline is batch only)."""

from .score import prepare_stream, score_stream  # noqa: F401
