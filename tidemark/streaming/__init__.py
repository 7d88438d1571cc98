"""Structured Streaming: incremental normalisation of newly landed raw runs."""
