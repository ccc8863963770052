"""Tables that cut a lineage: written where every executor can read them."""

from __future__ import annotations

import tempfile
import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


#: seconds between two collections of the driver's garbage
COLLECT_EVERY = 5.0


class Scratch:
    """A fresh folder below spark.checkpoint.dir, gone when the session ends.

    Where that setting is missing, a session on one machine gets a temporary
    folder; on a cluster that is an error, as executors share no such folder.
    """

    _collected = 0.0

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.conf.get("spark.master", "").startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="lakeferry-")
        self.folder = f"{shared.rstrip('/')}/{uuid4().hex}"
        self._files, path = self._at(self.folder)
        self._files.deleteOnExit(path)

    def _at(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame, written and read again. A name is used once, or dropped first.

        Shuffle files of the frame go once the driver has collected its garbage,
        which may take it half an hour; so that they don't pile up, it is asked to,
        but not after every one of many small tables.
        """
        frame.write.parquet(f"{self.folder}/{name}")
        if time.monotonic() - Scratch._collected > COLLECT_EVERY:
            self.spark._jvm.System.gc()
            Scratch._collected = time.monotonic()
        return self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Free tables of this folder that nothing reads any more."""
        for name in names:
            self._files.delete(self._at(f"{self.folder}/{name}")[1], True)

    def keep(self, *names: str) -> None:
        """Free all tables of this folder but these."""
        _, path = self._at(self.folder)
        held = [x.getPath().getName() for x in self._files.listStatus(path)]
        self.drop(*[name for name in held if name not in names])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not use (Spark ignores case)."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
