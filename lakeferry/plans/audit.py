"""An audit of the layers: does any sensitive value of the raw one stand in the masked one?

Values are looked for in all columns, not only in their own: a phone may stand in a
remark. The values make a compact filter, bits at two places of a hash, of a
size that does not depend on the table. The masked layer is passed over once, and
what the filter lets through is few; the raw values of those few are found by
a filter the other way round. Only what passes both is shuffled and compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeferry.functions.days import partition_value
from lakeferry.operators.warehouse import DAY, Warehouse
from lakeferry.plans.specs import TableSpec

#: Bits of a filter; 8 MB. With a hundred million values, it still keeps back nine in ten.
FILTER_BITS = 1 << 26
# Bits of a row that Spark's bitmap functions make.
_CHUNK = 1 << 15
#: Values of fewer characters stand anywhere by chance.
LEAST_CHARS = 4


def _places(value: Column, bits: int) -> list[Column]:
    mark = F.xxhash64(value)
    return [place.bitwiseAND(F.lit(bits - 1)) for place in (mark, F.shiftrightunsigned(mark, 32))]


def _filter(values: DataFrame, bits: int) -> Column:
    """The bits of all values (column value), as a column that looks up a frame of one row.

    What reaches the driver is the filter, whatever the number of values.
    """
    places = values.select(F.explode(F.array(*_places(F.col("value"), bits))).alias("place"))
    chunks = places.groupBy(F.floor(F.col("place") / _CHUNK).alias("chunk"))
    chunks = chunks.agg(F.bitmap_construct_agg(F.col("place") % _CHUNK).alias("bits"))
    whole = np.zeros((-(-bits // _CHUNK), _CHUNK // 8), np.uint8)
    for row in chunks.toLocalIterator():
        whole[row.chunk] = np.frombuffer(row.bits, np.uint8)
    frame = values.sparkSession.createDataFrame([(bytearray(whole.tobytes()),)], "bits binary")
    return frame.scalar()


def _may_be_in(value: Column, held: Column, bits: int) -> Column:
    """Whether the filter has both bits of a value."""
    found = F.lit(True)
    for place in _places(value, bits):
        byte = F.conv(F.hex(F.substr(held, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1))
        found = found & (bit == 1)
    return found


def _stacked(frame: DataFrame, columns: Sequence[str], least: int, wanted=None) -> DataFrame:
    """(column, value) of the long enough values of some columns that are wanted."""
    cells = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        keep = F.length(value) >= least
        keep = keep & wanted(value) if wanted else keep
        cells.append(F.when(keep, F.struct(F.lit(name).alias("column"), value.alias("value"))))
    rows = frame.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    return rows.select("cell.column", "cell.value")


def shared_values(
    masked: DataFrame,
    raw: DataFrame,
    sensitive: Sequence[str],
    least: int = LEAST_CHARS,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """The values of sensitive columns of the raw layer that stand in text of the masked one.

    Columns: column (of the masked layer), raw_column, values (different ones)
    and cells (of the masked layer that hold one).
    """
    texts = [field.name for field in masked.schema if isinstance(field.dataType, StringType)]
    if not sensitive or not texts:
        empty = "column string, raw_column string, values long, cells long"
        return masked.sparkSession.createDataFrame([], empty)
    known = _filter(_stacked(raw, sensitive, least), bits)
    suspects = _stacked(masked, texts, least, lambda value: _may_be_in(value, known, bits))
    suspects = suspects.groupBy("column", "value").agg(F.count("*").alias("cells"))
    asked = _filter(suspects, bits)
    holders = _stacked(raw, sensitive, least, lambda value: _may_be_in(value, asked, bits))
    holders = holders.distinct().withColumnRenamed("column", "raw_column")
    found = suspects.join(holders, "value").groupBy("column", "raw_column")
    return found.agg(F.count("*").alias("values"), F.sum("cells").alias("cells"))


def leaks(
    warehouse: Warehouse,
    spec: TableSpec,
    days: Sequence[date] | None = None,
    least: int = LEAST_CHARS,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Where the published masked layer of a table shows raw values of its sensitive columns.

    Sensitive are the columns that either profile masks. ``days`` are those of a log to look at.
    """
    layers = [warehouse.spark.table(t) for t in (warehouse.masked(spec.name), warehouse.raw(spec.name))]
    if days is not None:
        layers = [x.where(F.col(DAY).isin([partition_value(day) for day in days])) for x in layers]
    sensitive = [c for c in spec.columns if c in {**spec.masks, **spec.strict_masks}]
    return shared_values(*layers, sensitive, least, bits)
