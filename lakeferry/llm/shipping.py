"""Sending this package to the Python workers of a session.

Functions that run inside tasks are sent by name, so workers must be able to
import the package, wherever the driver has it from. Spark serves the file from
the driver to its executors, as with --py-files.
"""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Send the package, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_has_lakeferry", False):
        return
    file = Path(tempfile.mkdtemp(prefix="lakeferry-")) / "lakeferry.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as packed:
        for path in sorted(_PACKAGE.rglob("*.py")):
            packed.write(path, path.relative_to(_PACKAGE.parent))
    context.addPyFile(str(file))
    context._has_lakeferry = True


def shipped(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage, whose first argument is the session, that sends the package first."""

    @functools.wraps(function)
    def run(spark: SparkSession, *arguments, **options) -> DataFrame:
        ship(spark)
        return function(spark, *arguments, **options)

    return run
