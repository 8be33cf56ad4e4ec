"""The dashboard document: three sections merged into one JSON text.

The document is kept as ordered fragments, one per machine and section, whose texts joined in
order are the JSON. So a fleet of any size is sorted and written by Spark, and no task or driver
holds the whole document.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clock import floor_to, instant, iso_string, to_utc
from millrace.operators.reports import (
    DASHBOARD_FRESHNESS,
    energy_share,
    hourly_energy,
    latest_reading,
    total_power,
)
from millrace.operators.sections import (
    REALTIME_MEASURES,
    hour_labels,
    json_text,
    line_chart_section,
    pie_chart_section,
    realtime_section,
)
from millrace.schemas import DAY, HOUR_TIER, MINUTE_TIER, RAW_TIER, Tier
from millrace.session import ensure_checkpoint_dir
from millrace.sources.folders import Folders
from millrace.sources.tiers import TierTables

log = logging.getLogger(__name__)

# Titles and unit of the charts.
LINE_TITLE = "Konsumsi Energi Per Jam"
PIE_TITLE = "Distribusi Konsumsi Per Mesin — Hari Ini"
PIE_UNIT = "kWh"

# Order of the fragments within the document.
HEAD, MACHINES, LINE_HEAD, DATASETS, PIE_HEAD, PIE_LABELS, PIE_MIDDLE, PIE_VALUES, TAIL = range(9)
ORDER = ("part", "rank", "machine_id", "location")


@dataclass(frozen=True)
class Sections:
    """Results behind the three sections; None where the query failed."""

    latest: DataFrame | None
    hourly: DataFrame | None
    share: DataFrame | None


def latest_for_dashboard(raw: DataFrame, now) -> DataFrame:
    return latest_reading(raw, now, DASHBOARD_FRESHNESS, REALTIME_MEASURES, prefix="", ordered=False)


def query_sections(spark: SparkSession, read: Callable[[Tier], DataFrame], now: datetime | str) -> Sections:
    """The three section queries, each run by itself, so that one may fail alone.

    ``read`` gives a tier's rows. A result has one row per machine, or 24, and feeds several
    fragments, so it is checkpointed.
    """
    ensure_checkpoint_dir(spark)
    return Sections(
        section_or_none("realtime", lambda: latest_for_dashboard(read(RAW_TIER), now)),
        section_or_none("line_chart", lambda: hourly_energy(read(HOUR_TIER), now, ordered=False)),
        section_or_none("pie_chart", lambda: energy_share(read(MINUTE_TIER), now, ordered=False)),
    )


def dashboard_of(tables: TierTables, now: datetime | str) -> DataFrame:
    """The document over the tier tables; each section scans only its part of a day."""

    def read(tier: Tier) -> DataFrame:
        now_utc = to_utc(now)
        start = now_utc - DASHBOARD_FRESHNESS if tier is RAW_TIER else floor_to(DAY, now_utc)
        return tables.read(tier, start)

    return merge_dashboard(tables.spark, query_sections(tables.spark, read, now), now)


def section_or_none(name: str, build: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return build().checkpoint()
    except Exception:
        log.warning("dashboard section %s failed", name, exc_info=True)
        return None


def merge_dashboard(
    spark: SparkSession,
    sections: Sections,
    now: datetime | str,
    line_title: str = LINE_TITLE,
    pie_title: str = PIE_TITLE,
) -> DataFrame:
    """Document fragments ``(part, rank, machine_id, location, text)``.

    A failed section takes its empty default, without title; one without rows keeps its title.
    """
    one = spark.range(1)
    generated = F.concat(F.lit('{"generated_at":'), json_text(iso_string(instant(now))))
    parts = []

    if sections.latest is None:
        parts.append(_piece(one, HEAD, generated, F.lit(_realtime_open("0.0"))))
    else:
        total = total_power(sections.latest)
        opening = F.concat(
            F.lit(',"realtime":{"total_power_kw":'), json_text(F.col("total_power_kw")), F.lit(',"machines":[')
        )
        parts.append(_piece(total, HEAD, generated, opening))
        element = F.to_json(
            F.struct("machine_id", "location", *REALTIME_MEASURES, "last_seen"), {"ignoreNullFields": "false"}
        )
        parts.append(_elements(realtime_section(sections.latest), MACHINES, element, location=F.col("location")))

    if sections.hourly is None:
        parts.append(_piece(one, LINE_HEAD, _line_open("", F.lit("[]"))))
    else:
        labels = hour_labels(sections.hourly)
        parts.append(_piece(labels, LINE_HEAD, _line_open(line_title, F.to_json("labels"))))
        element = F.to_json(F.struct(F.col("machine_id").alias("label"), "data"))
        rank = F.unix_micros("first_hour").cast("double")
        parts.append(_elements(line_chart_section(sections.hourly), DATASETS, element, rank=rank))

    title = "" if sections.share is None else pie_title
    parts.append(_piece(one, PIE_HEAD, F.lit(']},"pie_chart":{"title":'), _quoted(title), F.lit(',"labels":[')))
    parts.append(_piece(one, PIE_MIDDLE, F.lit('],"values":[')))
    parts.append(_piece(one, TAIL, F.lit('],"unit":'), _quoted(PIE_UNIT), F.lit("}}")))
    if sections.share is not None:
        pie = pie_chart_section(sections.share)
        rank = -F.col("total_kwh")
        parts.append(_elements(pie, PIE_LABELS, json_text(F.col("machine_id")), rank=rank))
        parts.append(_elements(pie, PIE_VALUES, json_text(F.col("value")), rank=rank))

    document = parts[0]
    for part in parts[1:]:
        document = document.unionByName(part)
    return document.orderBy(*ORDER)


def write_dashboard(document: DataFrame, path: str) -> None:
    """Write the JSON text; more than one part file reads as one document in file-name order."""
    document.select("text").write.mode("overwrite").text(path)


@dataclass(frozen=True)
class PublishedDashboard(Folders):
    """A dashboard that can be read while it is written anew.

    Every publication is a folder of its own. A pointer, an empty folder made in one step when the
    text is complete, carries its number and name; readers take the highest. Publications before the
    last ``keep`` go, so a reader has that long to finish. One writer at a time.
    """

    path: str
    keep: int = 3

    def publish(self, document: DataFrame) -> str:
        version = uuid.uuid4().hex
        write_dashboard(document, f"{self.path}/versions/{version}")
        number = max((n for n, _ in self._pointers()), default=0) + 1
        self._fs_mkdirs(f"{self.path}/current/{number}-{version}")
        pointers = self._pointers()
        for n, name in pointers[: -self.keep]:
            self._fs_delete(f"{self.path}/current/{n}-{name}")
        pointed = {name for _, name in pointers[-self.keep :]}
        for name in self._fs_list(f"{self.path}/versions"):  # also what a crash left without a pointer
            if name not in pointed:
                self._fs_delete(f"{self.path}/versions/{name}")
        return version

    def read(self) -> DataFrame:
        """The text of the newest publication, as lines in file order; an error if there is none."""
        pointers = self._pointers()
        if not pointers:
            raise FileNotFoundError(f"no dashboard is published in {self.path}")
        return self.spark.read.text(f"{self.path}/versions/{pointers[-1][1]}")

    def _pointers(self) -> list[tuple[int, str]]:
        names = (name.split("-") for name in self._fs_list(f"{self.path}/current"))
        return sorted((int(number), version) for number, version in names)


def _realtime_open(total: str) -> str:
    return f',"realtime":{{"total_power_kw":{total},"machines":['


def _line_open(title: str, labels: Column) -> Column:
    return F.concat(
        F.lit(']},"line_chart":{"title":'), _quoted(title), F.lit(',"labels":'), labels, F.lit(',"datasets":[')
    )


def _quoted(text: str) -> Column:
    return json_text(F.lit(text))


def _piece(rows: DataFrame, part: int, *texts: Column) -> DataFrame:
    return rows.select(
        F.lit(part).alias("part"),
        F.lit(None).cast("double").alias("rank"),
        F.lit(None).cast("string").alias("machine_id"),
        F.lit(None).cast("string").alias("location"),
        F.concat(*texts).alias("text"),
    )


def _elements(
    rows: DataFrame, part: int, text: Column, rank: Column | None = None, location: Column | None = None
) -> DataFrame:
    """Array elements; all but the first in order carry the comma."""
    keyed = rows.select(
        F.lit(part).alias("part"),
        (F.lit(None).cast("double") if rank is None else rank).alias("rank"),
        "machine_id",
        (F.lit(None).cast("string") if location is None else location).alias("location"),
        text.alias("text"),
    )
    position = F.struct("rank", "machine_id", "location")
    first = keyed.agg(F.min(position)).scalar()
    comma = F.when(position.eqNullSafe(first), F.lit("")).otherwise(F.lit(","))
    return keyed.withColumn("text", F.concat(comma, F.col("text")))
