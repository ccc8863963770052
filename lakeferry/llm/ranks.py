"""Numbers of rows in an order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch, free_name


def numbered(frame: DataFrame, order: list[Column], number: str, scratch: Scratch, name: str) -> DataFrame:
    """The rows with their number from 0 in an order, which should be one without ties.

    Rows are dealt to ranges of the order and sorted there; a row's number is its
    place in its range behind all ranges before. What is summed in one task is a
    row per range.
    """
    place = free_name(frame, "place")
    dealt = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    saved = scratch.save(dealt.withColumn(place, F.monotonically_increasing_id()), name)
    part = F.shiftright(place, 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = saved.groupBy(part.alias("part")).agg(F.count("*").alias("rows_"))
    sizes = sizes.select(
        F.col("part").alias(f"{place}_of"),
        F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias(f"{place}_before"),
    )
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    joined = saved.join(sizes, part == F.col(f"{place}_of"))
    return joined.withColumn(number, inside + F.col(f"{place}_before")).select(*frame.columns, number)
