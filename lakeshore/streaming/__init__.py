"""Structured Streaming jobs: exactly-once file loads and streaming upserts."""
