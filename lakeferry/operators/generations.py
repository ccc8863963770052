"""New rows for tables and days in folders of their own, switched to all together.

An overwrite in place deletes old files before the new ones are complete, so
readers find nothing for a while, and nothing at all if it fails; and two tables
overwritten one after the other differ in between. Here rows go to a new
folder, a generation, that nothing names yet. A switch is a change in the catalog
only: the location of a table, or of a day's partition. All switches of a load are
written to a journal first; if a load stops among them, the next one finishes
them from there. The generation before stays for those who read it, until the
next load of that table or day.

Loads of one table must not run at the same time: a load takes the journal of
another for that of a stopped one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from lakeferry.functions.days import partition_value
from lakeferry.session import WIDE_TABLES, applied

DAY = "yymmdd"

# Behind the folder of a table: where its generations lie.
GENERATIONS = "__generations"


@dataclass(frozen=True)
class Switch:
    """A table's new location, or a day's; a day without one is dropped."""

    table: str
    location: str | None
    day: int | None = None


def new_whole(frame: DataFrame, table: str) -> Switch:
    """Write the rows of an unpartitioned table to a new generation."""
    spark = frame.sparkSession
    new = f"{root_of(spark, table)}{GENERATIONS}/{uuid4().hex}"
    with applied(spark, WIDE_TABLES):
        frame.write.orc(new)
    return Switch(table, new)


def new_days(
    frame: DataFrame,
    table: str,
    days: Sequence[date],
    settings: Mapping[str, str] = WIDE_TABLES,
    compression: str | None = None,
) -> list[Switch]:
    """Write these days of a table to a new generation. Days without rows are to be dropped."""
    spark = frame.sparkSession
    new = f"{root_of(spark, table)}{GENERATIONS}/{uuid4().hex}"
    writer = frame.write.partitionBy(DAY)
    if compression:
        writer = writer.option("compression", compression)
    with applied(spark, settings):
        writer.orc(new)
    held = {folder.rsplit("/", 1)[1] for folder in folders(spark, new)}
    values = [partition_value(day) for day in days]
    places = {value: f"{new}/{DAY}={value}" for value in values if f"{DAY}={value}" in held}
    return [Switch(table, places.get(value), value) for value in values]


def switch(spark: SparkSession, switches: Sequence[Switch], journal: str) -> None:
    """Switch to all of these, or leave a journal to do so."""
    before = _locations(spark, switches)
    write_text(spark, journal, json.dumps([asdict(one) for one in switches]))
    _apply(spark, switches)
    delete(spark, journal)
    _clean(spark, switches, before)


def finish(spark: SparkSession, journal: str) -> bool:
    """Finish the switches of a load that stopped among them. Whether there was one."""
    if not exists(spark, journal):
        return False
    found = "".join(row.value for row in spark.read.text(journal).collect())
    _apply(spark, [Switch(**one) for one in json.loads(found)])
    delete(spark, journal)
    return True


def _apply(spark: SparkSession, switches: Sequence[Switch]) -> None:
    """Point the catalog to the new places; those that have been done change nothing."""
    for table in dict.fromkeys(one.table for one in switches):
        mine = [one for one in switches if one.table == table]
        held = set(list_partitions(spark, table)) if any(one.day for one in mine) else set()
        added = []
        for one in mine:
            if one.day is None:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{one.location}'")
            elif one.location and one.day in held:
                spark.sql(f"ALTER TABLE {table} PARTITION ({DAY}={one.day}) SET LOCATION '{one.location}'")
            elif one.location:
                added.append(f"PARTITION ({DAY}={one.day}) LOCATION '{one.location}'")
        if added:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
        gone = [one.day for one in mine if one.day and not one.location]
        if gone:
            drop_days(spark, table, gone)


def _locations(spark: SparkSession, switches: Sequence[Switch]) -> dict[tuple, str]:
    """Where the tables and days lie that are about to be switched."""
    out = {}
    for table in dict.fromkeys(one.table for one in switches):
        days = [one.day for one in switches if one.table == table and one.day]
        held = set(list_partitions(spark, table)) if days else set()
        if not days:
            out[table, None] = location(spark, table)
        for day in held.intersection(days):
            out[table, day] = location(spark, table, day)
    return out


def _clean(spark: SparkSession, switches: Sequence[Switch], before: dict[tuple, str]) -> None:
    """Delete generations that are neither the new ones nor those before."""
    for one in switches:
        root = root_of(spark, one.table)
        keep = {_end(x) for x in (one.location, before.get((one.table, one.day))) if x}
        if one.day is None:
            stale = [x for x in folders(spark, f"{root}{GENERATIONS}") if _end(x) not in keep]
            stale += folders(spark, root) if _end(root) not in keep else []
        else:
            stale = [x for x in _of_day(spark, root, one.day) if _end(x) not in keep]
        for folder in stale:
            delete(spark, folder)


def _end(folder: str) -> str:
    """What tells generations of a table apart, however the rest of the path is spelt."""
    return "/".join(folder.rstrip("/").split("/")[-2:])


def _of_day(spark: SparkSession, root: str, day: int) -> list[str]:
    """The folders of a day: in the table's own folder, and in all generations."""
    found = []
    for pattern in (f"{root}/{DAY}={day}", f"{root}{GENERATIONS}/*/{DAY}={day}"):
        files, path = files_of(spark, pattern)
        found += [str(x.getPath()) for x in files.globStatus(path) or []]
    return found


def root_of(spark: SparkSession, table: str) -> str:
    """The folder that a table was created with."""
    return location(spark, table).split(GENERATIONS)[0]


def location(spark: SparkSession, table: str, day: int | None = None) -> str:
    """Where a table, or a day of it, lies now."""
    part = f" PARTITION ({DAY}={day})" if day else ""
    described = spark.sql(f"DESCRIBE FORMATTED {table}{part}").where("col_name = 'Location'").collect()
    return described[0].data_type


def list_partitions(spark: SparkSession, table: str) -> list[int]:
    """The days a table holds, from the catalog."""
    return [int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def drop_days(spark: SparkSession, table: str, days: Iterable[int]) -> None:
    """Drop these days, where they exist, with all generations of them."""
    held = set(list_partitions(spark, table))
    gone = [day for day in days if day in held]
    if gone:
        parts = ", ".join(f"PARTITION ({DAY}={day})" for day in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        root = root_of(spark, table)
        for day in gone:
            for folder in _of_day(spark, root, day):
                delete(spark, folder)


def files_of(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = files_of(spark, folder)
    return files.exists(path)


def folders(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, which need not be there."""
    files, path = files_of(spark, folder)
    return [str(x.getPath()) for x in files.listStatus(path)] if files.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    files, path = files_of(spark, folder)
    files.delete(path, True)


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file, there in full or not at all."""
    files, path = files_of(spark, file)
    _, making = files_of(spark, f"{file}.{uuid4().hex}")
    out = files.create(making, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    files.delete(path, False)
    if not files.rename(making, path):
        raise OSError(f"cannot write {file}")
