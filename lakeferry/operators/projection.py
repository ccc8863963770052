"""Column allow-lists, masks in place, constants and schema eras."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mask = Callable[[Column], Column]


def project(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns, in this order and spelled this way."""
    return frame.select(*[F.col(name).alias(name) for name in columns])


def mask_columns(frame: DataFrame, masks: Mapping[str, Mask]) -> DataFrame:
    """Masked values in the place and under the name of the originals."""
    return frame.select(
        *[masks[name](F.col(name)).alias(name) if name in masks else name for name in frame.columns]
    )


def as_text(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Some columns as STRING, so that a masked value always fits its column."""
    return frame.withColumns({name: F.col(name).cast("string") for name in columns})


def constant(frame: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """The same text in every row of a column."""
    return frame.withColumns({name: F.lit(value) for name, value in constants.items()})


def era(frame: DataFrame, later: Mapping[str, str], cutoff: int | None) -> DataFrame:
    """Bring days from before and after a schema change to one shape.

    ``later`` holds the columns (with their types) that rows have only after
    the day ``cutoff``. Up to it they are NULL, and also if the frame, being of
    old days only, lacks them.
    """
    columns, held = {}, {name.lower() for name in frame.columns}
    for name, type_name in later.items():
        value = F.col(name) if name.lower() in held else F.lit(None).cast(type_name)
        columns[name] = F.when(F.col("yymmdd") > cutoff, value) if cutoff else value
    return frame.withColumns(columns)
