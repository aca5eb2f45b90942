"""Structured Streaming jobs: landing, splitting, windowed daily metrics."""
