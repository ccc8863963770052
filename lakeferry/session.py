"""Session settings, and the session that the command line, bench and tests start."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The JVM compiles no method above 8000 bytes. The one method that whole-stage
# codegen makes of a table of some 50 columns is longer, and then every row is
# interpreted. With this limit Spark takes its projections for such a stage,
# which are split into small methods (2.5 times as fast for 66 columns).
WIDE_TABLES = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Spark sorts the rows of a task by day before it writes them by day, unless it
# may hold a few files open. Where tasks have few days each, that spares sorting
# all that a task reads, which for a range of a database may be a great deal;
# a task with more days than this is sorted from there on.
FEW_DAYS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}

# Rebalancing is by size only where plans are made anew at run time.
ADAPTIVE = {"spark.sql.adaptive.enabled": "true"}

# Runtime re-planning sizes the shuffle of staging; 256 MB of shuffled rows
# become ORC files of a good size.
SETTINGS = {
    **ADAPTIVE,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    **WIDE_TABLES,
}


def start(name: str = "lakeferry", settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the settings above; those given take precedence."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def applied(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Some settings for the length of a block, in a session of someone else."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
