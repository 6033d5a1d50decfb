"""Structured Streaming: file-drop ingestion and keyed upsert per micro-batch."""
