"""The loads: a snapshot of a table, and days of a log.

A load reads the source once into staging, publishes both layers from there,
and only then drops old staging. An exception anywhere stops it, so a failed
read is never published and never costs staged rows of another day. Running a
load again gives the same tables.

No step shuffles, apart from staging a log whose rows are not grouped by day.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.cleaning import clean
from lakeferry.functions.days import as_day, back, list_days, partition_value
from lakeferry.operators.projection import as_text, constant, era, mask_columns, project
from lakeferry.operators.warehouse import DAY, Warehouse
from lakeferry.plans.profiles import COMPAT, Profile
from lakeferry.plans.specs import TableSpec
from lakeferry.session import FEW_DAYS, WIDE_TABLES, applied
from lakeferry.sources import Source

# Fixed value: the last day of the log without the later columns.
LAST_OLD_DAY = 20180420


@dataclass(frozen=True)
class Reading:
    """How rows are cleaned on the way in, beyond what a table says itself.

    ``zone`` is where instants are shown as wall-clock times; ``unreadable``
    ("fail" or "null") what becomes of text that should be a time; ``times`` is
    off to leave such text as it is.
    """

    zone: str | None = None
    unreadable: str = "fail"
    times: bool = True

    def clean(self, frame: DataFrame, spec: TableSpec) -> DataFrame:
        """Cleaned rows of a source that has all listed columns.

        Staging may hold the columns of an earlier day, so one that the source has
        lost would be published as NULL.
        """
        held = {column.lower() for column in frame.columns}
        lost = [c for c in spec.columns if c.lower() not in held and c not in spec.later]
        if lost:
            raise ValueError(f"the source of {spec.name} lacks {', '.join(lost)}")
        return clean(frame, spec.datetimes if self.times else (), self.zone, self.unreadable)


PLAIN = Reading()

# What the writes of a snapshot are run with.
SNAPSHOT_WRITES = {**WIDE_TABLES, **FEW_DAYS}


def _one_state(source: Source, name: str, days: Sequence[date] | None = None):
    """Keep a table, or its shards of some days, as they are, where the source can."""
    if not hasattr(source, "held"):
        return nullcontext()
    return source.held([name] if days is None else source.shard_names(name, days))


def stage_snapshot(
    source: Source,
    warehouse: Warehouse,
    spec: TableSpec,
    day: str | date,
    reading: Reading = PLAIN,
) -> None:
    """Copy the whole table, with all its columns, into one day of staging."""
    with _one_state(source, spec.name):
        frame = reading.clean(source.read_split(spec.name, spec.key, spec.readers), spec)
        staged = frame.withColumn(DAY, F.lit(partition_value(day)))
        warehouse.stage(staged, spec.name, [as_day(day)], aligned=True)


def layers(
    staged: DataFrame, spec: TableSpec, profile: Profile, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The masked and the raw layer, equal in columns and types."""
    masks = spec.masks_for(profile)
    frame = project(staged, spec.columns + keep)
    if not profile.is_strict:
        frame = constant(frame, spec.constants)
    raw = as_text(frame, list(masks))
    return mask_columns(raw, masks), raw


def unmasked(spec: TableSpec, profile: Profile) -> list[str]:
    """The columns that are equal in both layers."""
    masks = spec.masks_for(profile)
    return [column for column in spec.columns if column not in masks]


def load_snapshot(
    source: Source,
    warehouse: Warehouse,
    spec: TableSpec,
    today: str | date,
    profile: Profile = COMPAT,
    reading: Reading = PLAIN,
) -> None:
    """Stage the table under yesterday, publish that day, drop all days before."""
    day = back(today, 1)
    stage_snapshot(source, warehouse, spec, day, reading)
    masked, raw = layers(warehouse.staged(spec.name, [day]), spec, profile)
    warehouse.publish(masked, raw, spec.name, unmasked(spec, profile))
    warehouse.expire(spec.name, back(today, 2))


def load_snapshots(
    source: Source,
    warehouse: Warehouse,
    specs: Sequence[TableSpec],
    today: str | date,
    profile: Profile = COMPAT,
    reading: Reading = PLAIN,
    at_once: int = 1,
) -> None:
    """Load several tables, some of them at a time.

    They don't depend on each other: if one fails, the others are loaded all the
    same, and then its exception is raised.
    """

    def load(spec: TableSpec) -> None:
        load_snapshot(source, warehouse, spec, today, profile, reading)

    # held for all, so that no load puts settings back that another one needs
    with applied(warehouse.spark, SNAPSHOT_WRITES), ThreadPoolExecutor(at_once) as pool:
        loads = [pool.submit(inheritable_thread_target(warehouse.spark)(load), spec) for spec in specs]
    for done in loads:
        done.result()


def stage_days(
    source: Source,
    warehouse: Warehouse,
    spec: TableSpec,
    start: str | date,
    end: str | date,
    reading: Reading = PLAIN,
) -> list[date]:
    """Copy the log of all days from start to end into staging, in one job."""
    days = list_days(start, end)
    if days:
        with _one_state(source, spec.name, days):
            shards = source.read_shards(spec.name, days, spec.key, spec.readers, spec.schema)
            warehouse.stage(reading.clean(shards, spec), spec.name, days, aligned=source.day_aligned)
    return days


def load_days(
    source: Source,
    warehouse: Warehouse,
    spec: TableSpec,
    start: str | date,
    end: str | date,
    last_old_day: int | None = LAST_OLD_DAY,
    profile: Profile = COMPAT,
    reading: Reading = PLAIN,
) -> None:
    """Load a range of days: one job for staging and one for each layer.

    Staging keeps the last two days, as if the days had come one by one.
    """
    days = stage_days(source, warehouse, spec, start, end, reading)
    if not days:
        return
    staged = era(warehouse.staged(spec.name, days), spec.later, last_old_day)
    masked, raw = layers(staged, spec, profile, keep=(DAY,))
    warehouse.publish_days(masked, raw, spec.name, days, unmasked(spec, profile))
    warehouse.expire(spec.name, back(days[-1], 2))


def load_day(
    source: Source,
    warehouse: Warehouse,
    spec: TableSpec,
    day: str | date,
    profile: Profile = COMPAT,
    reading: Reading = PLAIN,
) -> None:
    """Load one day, taken to be of the newer schema."""
    load_days(source, warehouse, spec, day, day, None, profile, reading)
