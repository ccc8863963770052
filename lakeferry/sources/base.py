"""What the loads ask of a source."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class Source(Protocol):
    """Where tables come from.

    ``day_aligned`` tells whether a partition of ``read_shards`` holds rows of
    few days, so that it can be written by day without a shuffle.
    """

    day_aligned: bool

    def read_table(self, name: str) -> DataFrame:
        """The whole table."""

    def read_split(self, name: str, key: str, readers: int = 1) -> DataFrame:
        """The whole table, in parallel ranges of ``key`` where that helps."""

    def read_shards(
        self,
        base: str,
        days: Sequence[date],
        key: str | None = None,
        readers: int = 1,
        schema: StructType | str | None = None,
    ) -> DataFrame:
        """The log of exactly these days, each row tagged with its day in ``yymmdd``.

        A day that was never delivered is an error; one that is there and empty
        gives no rows. ``schema`` is for sources that would have to infer one.
        """
