"""Structured Streaming forms of ingestion and counting."""
