"""Tables of a relational database over JDBC."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeferry.functions.days import partition_value
from lakeferry.sources.splits import Cutter

# Connection settings that decide what the rows look like (text
# encoding, zero dates, one-bit integers, time zone) and how they are fetched.
MYSQL_SETTINGS = {
    "useUnicode": "true",
    "characterEncoding": "UTF-8",
    "zeroDateTimeBehavior": "convertToNull",
    "tinyInt1isBit": "false",
    "serverTimezone": "Asia/Shanghai",
    "useSSL": "true",
    "dontTrackOpenResources": "true",
    "defaultFetchSize": "10000",
    "useCursorFetch": "true",
}
FETCH_SIZE = 10000

# Rows that one range should hold at most, unless they have one key.
RANGE_ROWS = 1_000_000


def mysql_url(host: str, database: str, **changes: str) -> str:
    """The URL of a database; ``changes`` replaces settings, for other drivers."""
    settings = "&".join(f"{k}={v}" for k, v in {**MYSQL_SETTINGS, **changes}.items())
    return f"jdbc:mysql://{host}/{database}?{settings}"


class JdbcSource:
    """Reads over JDBC.

    ``readers`` is the least number of ranges that a split read uses. A single
    connection would draw a whole table through one task, so it is above one. A
    large table has more: one for every ``range_rows`` rows, so that a task and
    what is lost with it stay of one size. The database is asked how many rows
    each range holds, and none has over twice its share, but for single keys without
    a second column to cut them by. That reads the key (its index, if it has one) a few times.

    ``connections`` bounds how many ranges are read at a time, for a database
    that a large cluster would overrun: it gathers ranges into so many tasks,
    which read them one after another. Where tasks must stay small, leave it
    unset and give the application no more cores than connections.

    The rows depend on none of these.

    Readers are transactions of their own, so rows that others write, move or delete while
    they read may be missed or read twice. With ``hold``, the tables of a load are
    locked against writers from before the first cut until the rows are staged
    (by one connection of the driver; readers are not in its way), so that all
    readers see one state. Writers wait for that long, or give up.
    """

    day_aligned = True

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str] | None = None,
        readers: int = 8,
        connections: int | None = None,
        range_rows: int = RANGE_ROWS,
        hold: bool = False,
    ):
        self.spark = spark
        self.url = url
        self.properties = {"fetchsize": str(FETCH_SIZE), **(properties or {})}
        self.readers = readers
        self.connections = connections
        self.range_rows = range_rows
        self.hold = hold
        # MySQL quotes names in its own way, and reads backslashes as escapes
        self._mysql = url.startswith("jdbc:mysql:")
        self._quote = "`" if self._mysql else '"'

    @contextmanager
    def held(self, names: Sequence[str]) -> Iterator[None]:
        """Keep tables as they are for the length of a block, if the source is to ``hold``."""
        if not self.hold or not names:
            yield
            return
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.java.lang.Class.forName(self.properties["driver"])
        given = jvm.java.util.Properties()
        for key, value in self.properties.items():
            given.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, given)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for lock in self._locks(names):
                statement.execute(lock)
            yield
        finally:
            if self._mysql:
                connection.createStatement().execute("UNLOCK TABLES")
            connection.rollback()
            connection.close()

    def _locks(self, names: Sequence[str]) -> list[str]:
        if self._mysql:  # all in one statement, as each one gives up what was locked before
            return ["LOCK TABLES " + ", ".join(f"{name} READ" for name in names)]
        return [f"LOCK TABLE {name} IN SHARE MODE" for name in names]

    def shard_names(self, base: str, days: Sequence[date]) -> list[str]:
        return [f"{base}_{partition_value(day)}" for day in days]

    def read_table(self, name: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, name, properties=self.properties)

    def read_split(
        self, name: str, key: str, readers: int = 1, second: str | None = None
    ) -> DataFrame:
        """``second`` is a column that cuts a single key with more rows than a range should hold."""
        return self._bounded(self._read_ranges(name, self._conditions([name], key, readers, second)[name]))

    def read_shards(
        self,
        base: str,
        days: Sequence[date],
        key: str | None = None,
        readers: int = 1,
        schema: StructType | str | None = None,
        second: str | None = None,
    ) -> DataFrame:
        """The tables ``<base>_<yyyyMMdd>`` as one frame, joined by column name.

        A column that some days lack is NULL there; a day without a table is an
        error of the database. ``schema`` is not needed.
        """
        names = dict(zip(map(partition_value, days), self.shard_names(base, days), strict=True))
        found = self._conditions(list(names.values()), key, readers, second) if key else {}
        shards = []
        for day, name in names.items():
            frame = self._read_ranges(name, found.get(name, []))
            shards.append(frame.withColumn("yymmdd", F.lit(day)))
        return self._bounded(_union_by_name(shards))

    def _read_ranges(self, name: str, conditions: Sequence[str]) -> DataFrame:
        if len(conditions) < 2:
            return self.read_table(name)
        return self.spark.read.jdbc(
            self.url, name, predicates=list(conditions), properties=self.properties
        )

    def _ask(self, query: str) -> list:
        frame = self.spark.read.jdbc(self.url, f"({query}) asked", properties=self.properties)
        return frame.collect()

    def _conditions(
        self, names: Sequence[str], key: str, readers: int, second: str | None
    ) -> dict[str, list[str]]:
        cutter = Cutter(
            self._ask,
            self._quoted(key),
            max(readers, self.readers),
            self.range_rows,
            self._mysql,
            self._quoted(second) if second else None,
        )
        return cutter.conditions(names)

    def _bounded(self, frame: DataFrame) -> DataFrame:
        return frame.coalesce(self.connections) if self.connections else frame

    def _quoted(self, column: str) -> str:
        return f"{self._quote}{column}{self._quote}"


def _union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Unite frames half by half.

    One after another, each union analyses all those before it: 40 seconds for
    a year of days, against two.
    """
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    first, second = _union_by_name(frames[:half]), _union_by_name(frames[half:])
    return first.unionByName(second, allowMissingColumns=True)
