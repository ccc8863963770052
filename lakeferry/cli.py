"""Command line: snapshots, a range of log days, or one log day.

    python -m lakeferry snapshot agency user_base --today 2018-04-21 --mysql db:3306/pay ...
    python -m lakeferry days order_log 2018-04-01 2018-04-20 --mysql db:3306/log ...
    python -m lakeferry day order_log 2018-04-21 --mysql db:3306/log ...
    python -m lakeferry stage order_log 2018-04-01 2018-04-20 --mysql db:3306/log ...

Days may be written 2018-04-21, 2018/04/21 or 20180421.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from lakeferry.functions.days import as_day
from lakeferry.operators.warehouse import Warehouse
from lakeferry.plans.loads import Reading, load_day, load_days, load_snapshots, stage_days
from lakeferry.plans.profiles import COMPAT, HashKey, strict
from lakeferry.plans.specs import LOG_TABLES, SNAPSHOT_TABLES
from lakeferry.session import start
from lakeferry.sources import FileSource, JdbcSource, mysql_url
from lakeferry.sources.jdbc import RANGE_ROWS


def _pair(text: str) -> tuple[str, str]:
    name, equals, value = text.partition("=")
    if not equals:
        raise argparse.ArgumentTypeError(f"not NAME=VALUE: {text}")
    return name, value


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    origin = shared.add_mutually_exclusive_group(required=True)
    origin.add_argument("--mysql", metavar="HOST:PORT/DATABASE")
    origin.add_argument("--url", help="any other JDBC URL")
    origin.add_argument("--files", metavar="FOLDER", help="tables as files")
    shared.add_argument("--format", default="parquet", help="format of --files")
    shared.add_argument("--user")
    shared.add_argument("--password-file", type=Path)
    shared.add_argument("--driver", help="JDBC driver class")
    shared.add_argument(
        "--option", action="append", default=[], type=_pair, metavar="NAME=VALUE",
        help="option of the reader of --files, such as header=true",
    )
    shared.add_argument("--schema-file", type=Path, help="columns and types of --files, as DDL")
    shared.add_argument(
        "--quarantine", metavar="FOLDER",
        help="where malformed records of --files go, which otherwise fail the load",
    )
    shared.add_argument("--zone", help="show instants as wall-clock times of this zone")
    shared.add_argument("--unreadable-times", choices=("fail", "null"), default="fail")
    shared.add_argument("--plain-times", action="store_true", help="leave times in text as they are")
    shared.add_argument("--readers", type=int, default=8, help="least key ranges per table")
    shared.add_argument("--range-rows", type=int, default=RANGE_ROWS, help="rows of a key range")
    shared.add_argument("--connections", type=int, help="ranges read at a time")
    shared.add_argument("--hold", action="store_true", help="lock tables against writers while they are read")
    shared.add_argument("--masked-db", default="ods_masked")
    shared.add_argument("--raw-db", default="ods_raw")
    shared.add_argument("--location", help="folder for databases that do not exist yet")
    shared.add_argument("--strict", action="store_true", help="mask all that is sensitive")
    shared.add_argument("--salt-file", type=Path, help="salt of hashes; --strict needs it or a key")
    shared.add_argument("--key-file", type=Path, help="key of hashes, which plans and logs don't show")
    shared.add_argument("--key-id", default="k1", help="what hashes made with the key begin with")
    shared.add_argument("--columns-of", metavar="TABLE", help="load as this known table")

    top = argparse.ArgumentParser(prog="lakeferry", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)
    snapshot = commands.add_parser("snapshot", parents=[shared], help="load whole tables")
    snapshot.add_argument("tables", nargs="+", metavar="table")
    snapshot.add_argument("--today", type=as_day, required=True, help="the day of the run")
    snapshot.add_argument("--at-once", type=int, default=1, help="tables loaded at a time")
    for command, text in (("days", "load a range of days"), ("stage", "only stage the days")):
        ranged = commands.add_parser(command, parents=[shared], help=text)
        ranged.add_argument("table")
        ranged.add_argument("start", type=as_day)
        ranged.add_argument("end", type=as_day)
    single = commands.add_parser("day", parents=[shared], help="load one day")
    single.add_argument("table")
    single.add_argument("day", type=as_day)
    return top


def _schema(given: argparse.Namespace) -> str | None:
    return given.schema_file.read_text().strip() if given.schema_file else None


def _source(spark: SparkSession, given: argparse.Namespace):
    if given.files:
        options, schema = dict(given.option), _schema(given)
        suffix = f".{given.format}"
        return FileSource(spark, given.files, given.format, suffix, options, schema, given.quarantine)
    url = given.url or mysql_url(*given.mysql.split("/", 1))
    password = given.password_file.read_text().strip() if given.password_file else None
    properties = {"user": given.user, "password": password, "driver": given.driver}
    return JdbcSource(
        spark,
        url,
        {name: value for name, value in properties.items() if value},
        given.readers,
        given.connections,
        given.range_rows,
        given.hold,
    )


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    given = parser().parse_args(arguments)
    known = SNAPSHOT_TABLES if given.command == "snapshot" else LOG_TABLES
    specs = []
    for table in given.tables if given.command == "snapshot" else [given.table]:
        model = given.columns_of or table
        if model not in known:
            raise SystemExit(f"unknown table {model}; known are {', '.join(known)}")
        schema = _schema(given) or known[model].schema
        specs.append(replace(known[model], name=table, schema=schema))
    if given.strict and not (given.salt_file or given.key_file):
        raise SystemExit("--strict needs --salt-file or --key-file")
    reading = Reading(given.zone, given.unreadable_times, not given.plain_times)
    salt = given.salt_file.read_text().strip() if given.salt_file else None
    spark = spark or start()
    key = HashKey.of(spark, given.key_id, given.key_file.read_bytes().strip()) if given.key_file else None
    profile = strict(salt, key) if given.strict else COMPAT

    source = _source(spark, given)
    warehouse = Warehouse(spark, given.masked_db, given.raw_db).create(given.location)
    try:
        _load(given, source, warehouse, specs, profile, reading)
    finally:
        for name, records in getattr(source, "quarantined", {}).items():
            if records:
                print(f"{records} malformed records of {name} are in {given.quarantine}/{name}")


def _load(given: argparse.Namespace, source, warehouse, specs, profile, reading) -> None:
    if given.command == "snapshot":
        load_snapshots(source, warehouse, specs, given.today, profile, reading, given.at_once)
        return
    spec = specs[0]
    if given.command == "days":
        load_days(
            source, warehouse, spec, given.start, given.end, profile=profile, reading=reading
        )
    elif given.command == "stage":
        stage_days(source, warehouse, spec, given.start, given.end, reading)
    else:
        load_day(source, warehouse, spec, given.day, profile, reading)
