"""Published tables: ``<path>/<name>/version=<v>/date=<date>/``, as CSV or Parquet.

What was written counts from when a commit file of its date names it, and a commit
names all tables of a date: ``<path>/_commits/date=<date>/<number>.json``.  It also
holds the columns of each table, so loading looks at no file to find them out.
Folders ``<path>/<name>/date=<date>/`` that no commit knows, as other programs write
them, are read as well; only for these are header lines searched.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forumgauge import schemas
from forumgauge.sources.commits import CommitLog, Folder

FORMATS = ("csv", "parquet")
COMMITS = "_commits"
COMMITS_AT_ONCE = 16
COMMIT = "number bigint, tables map<string, struct<folder: string, columns: array<string>>>, date string"


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")


@dataclass(frozen=True)
class Staged:
    """A written table that no commit names yet; no dates if it was empty."""

    name: str
    version: str
    columns: list[str]
    dates: list[str] = field(default_factory=list)


def stage_mart(table: DataFrame, name: str, path: str, date: str | None = None, fmt: str = "csv") -> Staged:
    """Write a table to a folder of its own, where no reader looks yet.

    Pass ``date`` for a single run, or a table that has a ``date`` column to write
    many dates at once.  A published table is a small aggregate, whose few rows
    adaptive execution has already gathered into as few tasks as they need.
    """
    _check(fmt)
    if date is not None:
        table = table.withColumn("date", F.lit(date))
    version = uuid.uuid4().hex
    written = Observation()
    writer = table.observe(written, F.count(F.lit(1)).alias("rows")).write.partitionBy("date")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(f"{path}/{name}/version={version}")
    folder = Folder(table.sparkSession, f"{path}/{name}/version={version}")
    dates = [folder_date.partition("=")[2] for folder_date in folder.names("date=*")] if written.get["rows"] else []
    if not dates:
        folder.delete("")
    return Staged(name, version, [c for c in table.columns if c != "date"], dates)


def commit_marts(spark: SparkSession, path: str, staged: Iterable[Staged]) -> None:
    """Make staged tables visible, all tables of a date in one step; what else the date has stays."""
    by_date: dict[str, dict] = {}
    for one in staged:
        for date in one.dates:
            by_date.setdefault(date, {})[one.name] = {"folder": f"version={one.version}/date={date}", "columns": one.columns}

    def commit(date: str) -> None:
        CommitLog(spark, f"{path}/{COMMITS}/date={date}").change(
            lambda before: {"tables": {**(before or {"tables": {}})["tables"], **by_date[date]}})

    # Each date is a few small file operations, which mostly wait.
    with ThreadPoolExecutor(COMMITS_AT_ONCE) as pool:
        list(pool.map(commit, by_date))


def write_mart(table: DataFrame, name: str, path: str, date: str | None = None, fmt: str = "csv") -> bool:
    """Write one table; False if it was empty, in which case nothing changes.

    Only the dates written are replaced.  The rows are counted while they are
    written, not by a separate pass.
    """
    staged = stage_mart(table, name, path, date, fmt)
    commit_marts(table.sparkSession, path, [staged])
    return bool(staged.dates)


def empty_mart(spark: SparkSession, name: str) -> DataFrame:
    """A published table without rows."""
    return spark.createDataFrame([], f"{schemas.fields_of(name)}, date string")


def committed(spark: SparkSession, path: str, date: str | None = None) -> dict[str, dict[str, dict]]:
    """date -> table -> folder and columns: what the latest commits name, a few small rows per date."""
    if date is not None:
        latest = CommitLog(spark, f"{path}/{COMMITS}/date={date}").latest()
        return {date: latest["tables"]} if latest else {}
    if not Folder(spark, path).names(f"{COMMITS}/date=*/[0-9]*.json"):
        return {}
    # A commit may be followed by another, and removed, while this reads.
    commits = spark.read.schema(COMMIT).option("ignoreMissingFiles", True).json(f"{path}/{COMMITS}")
    latest = commits.groupBy("date").agg(F.max_by("tables", "number").alias("tables"))
    return {row.date: {name: entry.asDict() for name, entry in row.tables.items()} for row in latest.collect()}


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of tables that no commit names; the number of folders deleted.

    Not to be run beside a publishing job, whose staged folders it would take.
    """
    live = {f"{name}/{entry['folder']}" for tables in committed(spark, path).values() for name, entry in tables.items()}
    folder = Folder(spark, path)
    dead = [name for name in folder.names("*/version=*/date=*") if name not in live]
    for name in dead:
        folder.delete(name)
    for version in folder.names("*/version=*"):
        if not folder.names(f"{version}/date=*"):
            folder.delete(version)
    return len(dead)


def _header_lines(spark: SparkSession, folders: list[str], base: str, name: str) -> DataFrame:
    """value, date of the CSV header lines: those whose cells are all column names of the table.

    No row of data is one, as every published table has a number in each row.
    """
    known = F.array(*map(F.lit, schemas.fields(schemas.fields_of(name))))
    lines = spark.read.schema("value string, date string").option("basePath", base).text(folders)
    return lines.filter(F.size(F.array_except(F.split("value", ","), known)) == 0)


def _columns_found(spark: SparkSession, base: str, name: str, dates: list[str]) -> dict[str, list[str]]:
    """date -> columns of CSV folders that no commit knows; one row per date comes to the driver."""
    lines = _header_lines(spark, [f"{base}/date={d}" for d in dates], base, name)
    return {row.date: row.value.split(",") for row in lines.groupBy("date").agg(F.min("value").alias("value")).collect()}


def _read_csv(spark: SparkSession, base: str, name: str, columns: Mapping[str, tuple[str, list[str]]]) -> DataFrame:
    """CSV folders of dates, date -> (folder, columns), in one scan with columns aligned by name."""
    types = schemas.fields(schemas.fields_of(name))
    folders = [f"{base}/{folder}" for folder, _ in columns.values()]
    headers = sorted({tuple(names) for _, names in columns.values()})
    read = spark.read.option("header", True).option("basePath", base)
    if len(headers) == 1:
        ddl = ", ".join(f"`{c}` {types[c]}" for c in headers[0])
        return read.schema(f"{ddl}, date string").csv(folders).drop("version")
    # Cells are read by place; which header a date has says what they are.
    width = max(map(len, headers))
    cells = [f"_{i}" for i in range(width)]
    table = read.schema(", ".join(f"{c} string" for c in cells) + ", date string").csv(folders)
    which = spark.createDataFrame([(date, headers.index(tuple(names))) for date, (_, names) in columns.items()],
                                  "date string, _header int")

    def cell(column: str):
        places = [header.index(column) if column in header else -1 for header in headers]
        place = F.get(F.array(*map(F.lit, places)), F.col("_header"))
        return F.get(F.array(*cells), place).cast(types[column]).alias(column)

    written = [c for c in types if any(c in header for header in headers)]
    return table.join(which, "date").select(*map(cell, written), "date")


def _read_parquet(spark: SparkSession, base: str, name: str, columns: Mapping[str, tuple[str, list[str]]]) -> DataFrame:
    """Parquet folders of dates; columns that a date lacks are null."""
    types = schemas.fields(schemas.fields_of(name))
    written = {c for _, names in columns.values() for c in names}
    ddl = ", ".join(f"`{c}` {t}" for c, t in types.items() if c in written)
    return spark.read.schema(f"{ddl}, date string").option("basePath", base).parquet(
        *(f"{base}/{folder}" for folder, _ in columns.values())).drop("version")


def _load(spark: SparkSession, name: str, path: str, fmt: str, date: str | None,
          commits: Mapping[str, Mapping[str, dict]] | None) -> DataFrame:
    _check(fmt)
    base = f"{path}/{name}"
    if commits is None:
        commits = committed(spark, path, date)
    found = {d: (tables[name]["folder"], tables[name]["columns"]) for d, tables in sorted(commits.items()) if name in tables}
    others = [f.partition("=")[2] for f in Folder(spark, base).names(f"date={date or '*'}")]
    others = [d for d in others if d not in found]
    headers: dict[str, list[str]] = {}
    if others:
        headers = (_columns_found(spark, base, name, others) if fmt == "csv" else
                   {d: spark.read.parquet(f"{base}/date={d}").columns for d in others})
    # Folders of two layouts are two scans.
    layouts = [found, {d: (f"date={d}", header) for d, header in headers.items()}]
    read = _read_csv if fmt == "csv" else _read_parquet
    parts = [read(spark, base, name, layout) for layout in layouts if layout]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else empty_mart(spark, name)


def load_mart_dates(spark: SparkSession, name: str, dates: Iterable[str], path: str, fmt: str = "csv",
                    commits: Mapping[str, Mapping[str, dict]] | None = None) -> DataFrame:
    """Committed dates of a table; only their folders are read."""
    _check(fmt)
    commits = committed(spark, path) if commits is None else commits
    found = {d: (commits[d][name]["folder"], commits[d][name]["columns"]) for d in sorted(dates) if name in commits.get(d, {})}
    if not found:
        return empty_mart(spark, name)
    return (_read_csv if fmt == "csv" else _read_parquet)(spark, f"{path}/{name}", name, found)


def load_mart_all_dates(spark: SparkSession, name: str, path: str, fmt: str = "csv",
                        commits: Mapping[str, Mapping[str, dict]] | None = None) -> DataFrame:
    """A table over every date, columns aligned by name; empty if absent.

    Pass what :func:`committed` gave to load several tables of one state.
    """
    return _load(spark, name, path, fmt, None, commits)


def load_mart(spark: SparkSession, name: str, date: str, path: str, fmt: str = "csv") -> DataFrame:
    """A table of one date; empty if that date was not published.  Reads that date's folder only."""
    return _load(spark, name, path, fmt, date, None)


def list_dates(spark: SparkSession, path: str) -> DataFrame:
    """Sorted dates for which anything was published; no rows if none.

    Only the names of folders are looked at.
    """
    folder = Folder(spark, path)
    names = [*folder.names(f"{COMMITS}/date=*"), *folder.names("*/date=*/part-*")]
    dates = sorted({part.partition("=")[2] for name in names for part in name.split("/") if part.startswith("date=")})
    return spark.createDataFrame([(d,) for d in dates], "date string").orderBy("date")
