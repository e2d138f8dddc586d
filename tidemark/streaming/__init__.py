"""Structured Streaming jobs: file topic, foreachBatch consumer, marker stop."""
