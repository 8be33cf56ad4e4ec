"""Tiered machine-telemetry analytics as PySpark DataFrame jobs."""

from millrace.schemas import HOUR_TIER, MINUTE_TIER, RAW_TIER, Tier
from millrace.session import build_session, shared_dir

__all__ = [
    "HOUR_TIER",
    "MINUTE_TIER",
    "RAW_TIER",
    "Tier",
    "build_session",
    "shared_dir",
]
