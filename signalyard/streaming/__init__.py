"""Structured Streaming jobs: speed layer (STM1-5), count-triggered
batching (STM6), refresh loop (STM7), backfill planner (STM8)."""
