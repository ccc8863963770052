"""Staging and published tables in the catalog, all of them ORC.

Staging and logs are partitioned by the day, ``yymmdd INT``. Tables carry the
option ``partitionOverwriteMode=dynamic`` themselves, so replacing a day never
depends on how the session is set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from lakeferry.functions.days import partition_value
from lakeferry.operators import generations
from lakeferry.operators.generations import DAY, Switch, drop_days, list_partitions, location
from lakeferry.session import ADAPTIVE, FEW_DAYS, WIDE_TABLES, applied

__all__ = ["DAY", "LayersDiffer", "Warehouse", "list_partitions", "location"]

# Bits of a hash that are summed up; so few that the sum of any table fits.
SUMMED_BITS = 0xFFFFFF


class LayersDiffer(Exception):
    """The masked and the raw layer do not hold the same rows."""


@dataclass(frozen=True)
class Warehouse:
    """Two databases: one for masked tables, one for raw tables and staging."""

    spark: SparkSession
    masked_db: str = "ods_masked"
    raw_db: str = "ods_raw"

    def create(self, location: str | None = None) -> Warehouse:
        for database in (self.masked_db, self.raw_db):
            where = f" LOCATION '{location}/{database}'" if location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
        return self

    def masked(self, name: str) -> str:
        return f"{self.masked_db}.{name}"

    def raw(self, name: str) -> str:
        return f"{self.raw_db}.{name}"

    def staging(self, name: str) -> str:
        return f"{self.raw_db}.{name}_delta"

    def stage(self, frame: DataFrame, name: str, days: Sequence[date], aligned: bool) -> None:
        """Replace the staged days with the rows of ``frame``, which hold ``yymmdd``.

        A day without rows is left empty, and not with the rows of an earlier
        run; but nothing is dropped before the new rows are written, so a run
        that fails costs no staged day.

        ``aligned`` frames are written as they come. Others would leave one
        file per task and day; they are rebalanced by day once, which also
        spreads a day that is much larger than the others over many tasks. A
        single day is rebalanced by size alone.
        """
        self.finish(name)
        table = self.staging(name)
        create_shaped(frame, table, by_day=True, compression="snappy")
        add_columns(frame, table)
        settings = {**WIDE_TABLES, **FEW_DAYS}
        if not aligned:
            frame = frame.hint("rebalance", *([DAY] if len(days) > 1 else []))
            settings |= ADAPTIVE
        self._switch(name, generations.new_days(conform(frame, table), table, days, settings, "snappy"))

    def finish(self, name: str) -> bool:
        """Finish what a load of this table left half switched. Every load does so first."""
        return generations.finish(self.spark, self._journal(name))

    def _switch(self, name: str, switches: Sequence[Switch]) -> None:
        generations.switch(self.spark, switches, self._journal(name))

    def _journal(self, name: str) -> str:
        described = self.spark.sql(f"DESCRIBE DATABASE {self.raw_db}")
        return f"{described.where(F.col('info_name') == 'Location').first().info_value}/journal_{name}"

    def staged(self, name: str, days: Sequence[date]) -> DataFrame:
        """Rows of these days only, by pruning; staging may hold others.

        A single day is given as a literal, which spares its write the sort
        that Spark puts before every write by day.
        """
        wanted = [partition_value(day) for day in days]
        table = self.spark.table(self.staging(name))
        if len(wanted) > 1:
            return table.where(F.col(DAY).isin(wanted))
        return table.where(F.col(DAY) == wanted[0]).withColumn(DAY, F.lit(wanted[0]))

    def publish(
        self, masked: DataFrame, raw: DataFrame, name: str, same: Sequence[str] = ()
    ) -> None:
        """Replace both layers in full, at once.

        Both are written before either is switched to, and compared on the way
        (see ``Compared``); ``same`` are the columns that no mask changes.
        """
        self.finish(name)
        create_shaped(masked, self.masked(name))
        create_like(self.spark, self.raw(name), self.masked(name))
        compared = Compared(same)
        switches = []
        for frame, table in ((masked, self.masked(name)), (raw, self.raw(name))):
            switches.append(generations.new_whole(compared.watch(conform(frame, table)), table))
        compared.check(name)
        self._switch(name, switches)

    def publish_days(
        self,
        masked: DataFrame,
        raw: DataFrame,
        name: str,
        days: Sequence[date],
        same: Sequence[str] = (),
    ) -> None:
        """Replace these days in both layers, at once, and leave the others alone.

        Days without staged rows lose their partition. Staged files hold a day each,
        so a task has few days, whose rows need not be sorted.
        """
        self.finish(name)
        create_shaped(masked, self.masked(name), by_day=True)
        create_like(self.spark, self.raw(name), self.masked(name))
        compared = Compared(same)
        switches, settings = [], {**WIDE_TABLES, **FEW_DAYS}
        for frame, table in ((masked, self.masked(name)), (raw, self.raw(name))):
            watched = compared.watch(conform(frame, table))
            switches += generations.new_days(watched, table, days, settings)
        compared.check(name)
        self._switch(name, switches)

    def expire(self, name: str, last: date) -> None:
        """Retention: drop all days up to this one from staging, those of skipped runs too."""
        table, until = self.staging(name), partition_value(last)
        drop_days(self.spark, table, [day for day in list_partitions(self.spark, table) if day <= until])


class Compared:
    """Watches the layers of a table while they are written, in the same pass.

    Rows are counted, and NULLs in all columns, which masks leave NULL; the values of
    columns without a mask are summed up in a digest that does not depend on the
    order of rows.
    """

    def __init__(self, same: Sequence[str] = ()) -> None:
        self.same = {column.lower() for column in same}
        self.seen: list[Observation] = []

    def watch(self, layer: DataFrame) -> DataFrame:
        """The layer, observed.

        An observation interprets its expressions row by row, so NULLs and hashes
        are columns of a projection, which is compiled, up to there.
        """
        nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in layer.columns), F.lit(0).cast("long"))
        hashed = [
            F.col(f"`{field.name}`")
            for field in layer.schema
            if field.name.lower() in self.same and "map<" not in field.dataType.simpleString()
        ]
        mark = F.xxhash64(*hashed or [F.lit(0)])
        own = uuid4().hex
        counted, marked = f"nulls_{own}", f"mark_{own}"
        self.seen.append(Observation())
        watched = layer.select("*", nulls.alias(counted), mark.alias(marked)).observe(
            self.seen[-1],
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(counted), F.lit(0)).alias("nulls"),
            F.coalesce(F.bit_xor(marked), F.lit(0)).alias("parity"),
            F.coalesce(F.sum(F.col(marked).bitwiseAND(F.lit(SUMMED_BITS))), F.lit(0)).alias("total"),
        )
        return watched.drop(counted, marked)

    def check(self, name: str) -> None:
        found = [one.get for one in self.seen]
        if any(one != found[0] for one in found):
            raise LayersDiffer(f"the layers of {name} differ: {found}")


def create_shaped(
    frame: DataFrame, table: str, by_day: bool = False, compression: str | None = None
) -> None:
    """Create an empty ORC table with the columns of ``frame``, unless it exists.

    The filter folds to an empty relation, so nothing is read.
    """
    writer = frame.where("1 = 2").write.format("orc").mode("ignore")
    if compression:
        writer = writer.option("compression", compression)
    if by_day:
        writer = writer.partitionBy(DAY).option("partitionOverwriteMode", "dynamic")
    writer.saveAsTable(table)


def create_like(spark: SparkSession, table: str, model: str) -> None:
    """Create a table with the columns, format and partitioning of another."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} LIKE {model}")


def add_columns(frame: DataFrame, table: str) -> None:
    """Widen a table by the columns that a later source has gained."""
    known = _lower(frame.sparkSession.table(table))
    added = [field for field in frame.schema.fields if field.name.lower() not in known]
    if added:
        listed = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in added)
        frame.sparkSession.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")


def conform(frame: DataFrame, table: str) -> DataFrame:
    """The columns of the table by name, in its order and types; NULL for absent ones."""
    held = {field.name.lower(): field.dataType for field in frame.schema.fields}

    def value(field: StructField) -> Column:
        kind = held.get(field.name.lower())
        if kind is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = F.col(f"`{field.name}`")
        if kind == field.dataType:
            return column
        if not fits(kind, field.dataType):
            raise TypeError(f"{table}.{field.name} is {field.dataType.simpleString()}, not {kind.simpleString()}")
        return column.cast(field.dataType).alias(field.name)

    return frame.select(*map(value, frame.sparkSession.table(table).schema.fields))


def fits(kind: DataType, into: DataType) -> bool:
    """Whether all values of one type are values of another."""
    if kind == into or isinstance(kind, NullType):
        return True
    if isinstance(into, StringType):
        return isinstance(kind, AtomicType)
    digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
    if isinstance(kind, tuple(digits)):
        if isinstance(into, DecimalType):
            return into.precision - into.scale >= digits[type(kind)]
        return digits.get(type(into), 0) >= digits[type(kind)] or (
            isinstance(into, DoubleType) and not isinstance(kind, LongType)
        )
    if isinstance(kind, DecimalType) and isinstance(into, DecimalType):
        return into.scale >= kind.scale and into.precision - into.scale >= kind.precision - kind.scale
    if isinstance(kind, FloatType):
        return isinstance(into, DoubleType)
    if isinstance(kind, DateType):
        return isinstance(into, (TimestampType, TimestampNTZType))
    if type(kind) is not type(into):
        return False
    if isinstance(kind, ArrayType):
        return fits(kind.elementType, into.elementType)
    if isinstance(kind, MapType):
        return fits(kind.keyType, into.keyType) and fits(kind.valueType, into.valueType)
    if isinstance(kind, StructType):
        return len(kind) == len(into) and all(fits(x.dataType, y.dataType) for x, y in zip(kind, into))
    return True


def _lower(frame: DataFrame) -> set[str]:
    """Column names as Spark tells them apart."""
    return {name.lower() for name in frame.columns}


def overwrite(
    frame: DataFrame, table: str, settings: Mapping[str, str] = WIDE_TABLES
) -> None:
    """Replace the table, or in a table by day the days that ``frame`` has."""
    with applied(frame.sparkSession, settings):
        conform(frame, table).write.insertInto(table, overwrite=True)


def replace_whole(frame: DataFrame, table: str) -> None:
    """Replace an unpartitioned table, all at once (see ``generations``)."""
    spark = frame.sparkSession
    journal = f"{generations.root_of(spark, table)}_journal"
    generations.finish(spark, journal)
    generations.switch(spark, [generations.new_whole(conform(frame, table), table)], journal)
