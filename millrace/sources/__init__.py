"""Readers and writers: messages, line protocol, tier tables, the benchmark event table."""
