from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.schemas import RAW_SCHEMA, ROLLUP_SCHEMA  # noqa: E402
from millrace.session import build_session  # noqa: E402
from millrace.sources.tiers import TierTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path) -> TierTables:
    store = TierTables(spark, str(tmp_path / "tiers"))
    store.create()
    return store


@pytest.fixture
def raw_rows(spark):
    """Raw readings from ``(time, machine[, location[, power]])``; energy is power / 360."""

    def make(*rows: tuple):
        full = []
        for row in rows:
            time, machine, location, power = (*row, *("hall", 1.0)[len(row) - 2 :])
            energy = None if power is None else power / 360
            full.append((at(time), machine, location, power, energy, 220.0, 5.0, 0.9))
        return spark.createDataFrame(full, RAW_SCHEMA)

    return make


@pytest.fixture
def tier_rows(spark):
    """Tier rows from ``(time, machine, location, avg power, energy, samples)``."""

    def make(*rows: tuple):
        full = [(at(t), m, loc, p, e, 220.0, 5.0, 0.9, p, p, n) for t, m, loc, p, e, n in rows]
        return spark.createDataFrame(full, ROLLUP_SCHEMA)

    return make


def at(text: str | None) -> datetime | None:
    """An instant of 2024-01-01, or a full ISO text; UTC."""
    if text is None:
        return None
    value = datetime.fromisoformat(text if "-" in text else f"2024-01-01T{text}")
    return datetime.fromisoformat(value.isoformat() + "+00:00")


def rows_of(frame, *columns: str, digits: int | None = 9) -> list[tuple]:
    """Sorted plain rows; doubles rounded, as sums depend on the order of addition."""

    def plain_value(value):
        return round(value, digits) if isinstance(value, float) and digits is not None else value

    if columns:
        frame = frame.select(*columns)
    names = [(f.name, f.dataType.typeName()) for f in frame.schema.fields]
    plain = frame.select(*(frame[n].cast("string") if t.startswith("timestamp") else frame[n] for n, t in names))
    return sorted((tuple(plain_value(v) for v in r) for r in plain.collect()), key=str)
