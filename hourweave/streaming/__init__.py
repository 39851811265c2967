"""Structured Streaming jobs (scoring of independent windows as files arrive)."""
