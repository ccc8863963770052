"""Day-by-day copies of relational tables into a lake, published masked and raw.

Everything here is DataFrame code over built-in functions, so Spark plans,
splits and runs all of the work; the driver only names tables and days.
"""

from lakeferry.operators.warehouse import Warehouse
from lakeferry.plans.loads import Reading, load_day, load_days, load_snapshot, load_snapshots
from lakeferry.plans.audit import leaks
from lakeferry.plans.profiles import COMPAT, HashKey, strict
from lakeferry.plans.specs import LOG_TABLES, SNAPSHOT_TABLES, TableSpec
from lakeferry.sources import FileSource, FrameSource, JdbcSource

__all__ = [
    "COMPAT",
    "FileSource",
    "FrameSource",
    "HashKey",
    "JdbcSource",
    "LOG_TABLES",
    "Reading",
    "SNAPSHOT_TABLES",
    "TableSpec",
    "Warehouse",
    "leaks",
    "load_day",
    "load_days",
    "load_snapshot",
    "load_snapshots",
    "strict",
]
