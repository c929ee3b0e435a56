"""Structured Streaming face of the incremental load (landing files -> staging upsert)."""
