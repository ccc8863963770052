"""Tables that lie as files, one file or folder per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeferry.functions.days import partition_value
from lakeferry.operators.generations import delete, exists

# Formats that have records which may not be readable, and what Spark is to call these.
RECORDS = ("csv", "json")
MALFORMED = "_malformed"


class FileSource:
    """``<root>/<table><suffix>``; the shards of a log are ``<root>/<base>/yymmdd=<day>``.

    A record of delimited text or JSON that cannot be read as a row fails the read, and
    the error shows it. With ``quarantine``, a folder, such records go there
    instead, as JSON, by table (and day of a log): the file, the record, and what could be
    read of it; ``quarantined`` counts them by table. Reading again replaces them. That
    reads the files once more. A ``mode`` among the options is taken as it is.
    """

    day_aligned = True

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        file_format: str = "parquet",
        suffix: str = ".parquet",
        options: Mapping[str, str] | None = None,
        schema: str | None = None,
        quarantine: str | None = None,
    ):
        self.spark = spark
        self.root = root
        self.file_format = file_format
        self.suffix = suffix
        self.options = dict(options or {})
        #: of the tables, as DDL, for files that do not say themselves
        self.schema = schema
        self.quarantine = quarantine
        self.quarantined: dict[str, int] = {}

    def read_table(self, name: str) -> DataFrame:
        schema = StructType.fromDDL(self.schema) if self.schema else None
        return self._load(self._reader(), schema, [f"{self.root}/{name}{self.suffix}"], name)

    def read_split(self, name: str, key: str, readers: int = 1) -> DataFrame:
        """The same scan: files are split by size already, which needs no key."""
        return self.read_table(name)

    def read_shards(
        self,
        base: str,
        days: Sequence[date],
        key: str | None = None,
        readers: int = 1,
        schema: StructType | str | None = None,
    ) -> DataFrame:
        """The folders of these days, and no others, in one scan.

        Each folder must be there; an empty one is a day without rows. Columns go
        by name, so a column that some days lack is NULL there. Without ``schema``
        the footers of these days' files are read for it; formats without
        footers need one, as they would have to be read twice.
        """
        wanted = [partition_value(day) for day in days]
        folders = [f"{self.root}/{base}/yymmdd={value}" for value in wanted]
        lost = [folder for folder in folders if not exists(self.spark, folder)]
        if lost:
            raise FileNotFoundError(f"not delivered: {', '.join(lost)}")
        reader = self._reader().option("basePath", f"{self.root}/{base}")
        if schema:
            if isinstance(schema, str):
                schema = StructType.fromDDL(schema)
            if "yymmdd" not in schema.fieldNames():
                schema = StructType([*schema.fields, StructField("yymmdd", IntegerType())])
        elif self.file_format in ("parquet", "orc"):
            reader = reader.option("mergeSchema", "true")
        else:
            raise ValueError(f"a log of {self.file_format} files needs a schema")
        return self._load(reader, schema, folders, base, wanted)

    def _reader(self) -> DataFrameReader:
        return self.spark.read.format(self.file_format).options(**self.options)

    def _load(
        self,
        reader: DataFrameReader,
        schema: StructType | None,
        paths: Sequence[str],
        name: str,
        days: Sequence[int] = (),
    ) -> DataFrame:
        """The rows of some files, without malformed records."""
        if self.file_format not in RECORDS or "mode" in {option.lower() for option in self.options}:
            return (reader.schema(schema) if schema else reader).load(paths)
        if not self.quarantine:
            reader = reader.option("mode", "FAILFAST")
            return (reader.schema(schema) if schema else reader).load(paths)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
        schema = schema or reader.load(paths).schema
        fields = [field for field in schema if field.name != MALFORMED]
        whole = StructType([*fields, StructField(MALFORMED, StringType())])
        frame = reader.schema(whole).load(paths)
        self.quarantined[name] = self._set_aside(frame, name, days)
        return frame.where(F.col(MALFORMED).isNull()).drop(MALFORMED)

    def _set_aside(self, frame: DataFrame, name: str, days: Sequence[int]) -> int:
        """Write the malformed records of a table, or of days of a log, to quarantine."""
        folder = f"{self.quarantine}/{name}"
        for stale in [f"{folder}/yymmdd={day}" for day in days] or [folder]:
            delete(self.spark, stale)
        # all columns take part, so that a record is read as it is for the load
        read = F.to_json(F.struct(*[f"`{c}`" for c in frame.columns if c != MALFORMED]))
        bad = frame.where(F.col(MALFORMED).isNotNull()).select(
            F.col("_metadata.file_path").alias("file"),
            F.col(MALFORMED).alias("record"),
            read.alias("read"),
            *(["yymmdd"] if days else []),
        )
        seen = Observation()
        bad = bad.observe(seen, F.count(F.lit(1)).alias("records"))
        writer = bad.write.mode("append")
        (writer.partitionBy("yymmdd") if days else writer).json(folder)
        return seen.get["records"]
