"""Structured Streaming: ingest, minute and hour roll-ups with a bound on lateness."""
