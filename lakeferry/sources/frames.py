"""Tables that are frames already: views, other tables, results of a query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeferry.functions.days import back, day_key, partition_value


class FrameSource:
    """Frames by table name; a log is a frame and its time column.

    Say ``day_aligned`` if the frames of logs lie in the order of time.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame] | None = None,
        logs: Mapping[str, tuple[DataFrame, str]] | None = None,
        day_aligned: bool = False,
    ):
        self.tables = dict(tables or {})
        self.logs = dict(logs or {})
        self.day_aligned = day_aligned

    def read_table(self, name: str) -> DataFrame:
        return self.tables[name]

    def read_split(self, name: str, key: str, readers: int = 1) -> DataFrame:
        return self.read_table(name)

    def read_shards(
        self,
        base: str,
        days: Sequence[date],
        key: str | None = None,
        readers: int = 1,
        schema: StructType | str | None = None,
    ) -> DataFrame:
        """Rows of the days; the filter is on the time itself, to reach the scan.

        A row without a time belongs to no day, and fails the read.
        """
        frame, time = self.logs[base]
        first, after = min(days).isoformat(), back(max(days), -1).isoformat()
        inside = (F.col(time) >= F.lit(first).cast("timestamp_ntz")) & (
            F.col(time) < F.lit(after).cast("timestamp_ntz")
        )
        lost = F.raise_error(F.lit(f"a row of {base} has no {time}")).cast("int")
        tagged = frame.where(inside | F.col(time).isNull()).withColumn(
            "yymmdd", F.when(F.col(time).isNull(), lost).otherwise(day_key(F.col(time)))
        )
        if len(set(days)) == (max(days) - min(days)).days + 1:
            return tagged
        return tagged.where(F.col("yymmdd").isin([partition_value(day) for day in days]))
