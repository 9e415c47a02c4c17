"""File names, partition paths and URLs of hourly dumps, as scalars and as columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed forms: an hourly dump's name ends so, and a Silver file lies so below its table.
DUMP_NAME = r"pageviews-(\d{4})(\d{2})(\d{2})-(\d{2})0000\.gz$"
SILVER_PATH = r"date=([^/]+)/hour=(\d+)/project=([^/]+)/access_mode=([^/]+)/[^/]+\.parquet$"


def parse_dump_name(name: str) -> tuple[str, int]:
    """('YYYY-MM-DD', hour) of a dump's file name; ValueError for any other name."""
    if not (m := re.search(DUMP_NAME, name)):
        raise ValueError(f"not the name of an hourly dump: {name}")
    return f"{m[1]}-{m[2]}-{m[3]}", int(m[4])


def dump_stamp(name: Column) -> Column:
    """'YYYYMMDD-HH' of a dump's file name, or the empty text: the one pattern match that a line needs."""
    return F.regexp_extract(name, r"pageviews-(\d{8}-\d{2})0000\.gz$", 1)


def dump_date(stamp: Column) -> Column:
    """Date of a dump_stamp; null where it is empty or no date."""
    return F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2)).try_cast("date")


def dump_hour(stamp: Column) -> Column:
    """Hour of a dump_stamp; null where it is empty or not within a day."""
    hour = F.substring(stamp, 10, 2).try_cast("int")
    return F.when(hour.between(0, 23), hour)


def dump_name(at: datetime) -> str:
    return f"pageviews-{_utc(at):%Y%m%d-%H}0000.gz"


def dump_folder(at: datetime) -> str:
    return f"{_utc(at):%Y}/{_utc(at):%Y-%m}"


def dump_path(base: str | Path, at: datetime) -> Path:
    """Where a dump is kept: <base>/YYYY/YYYY-MM/<name>."""
    return Path(base) / dump_folder(at) / dump_name(at)


def dump_url(at: datetime, base_url: str) -> str:
    return f"{base_url.rstrip('/')}/{dump_folder(at)}/{dump_name(at)}"


def _utc(at: datetime) -> datetime:
    return at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)


def hours(start: date, end: date, only: set[int] | None = None) -> Iterator[datetime]:
    """Every hour from the first of start to the last of end, or those of `only`."""
    at, last = datetime(start.year, start.month, start.day, tzinfo=UTC), datetime(end.year, end.month, end.day, 23, tzinfo=UTC)
    while at <= last:
        if only is None or at.hour in only:
            yield at
        at += timedelta(hours=1)


def hour_spine(spark: SparkSession, start: date, end: date, only: set[int] | None = None) -> DataFrame:
    """(date, hour, filename) of every hour of the days, built on the executors."""
    first, last = f"timestamp_ntz'{start:%Y-%m-%d} 00:00:00'", f"timestamp_ntz'{end:%Y-%m-%d} 23:00:00'"
    out = spark.range(1).select(F.explode(F.expr(f"sequence({first}, {last}, interval 1 hour)")).alias("ts"))
    if only is not None:
        out = out.where(F.hour("ts").isin(sorted(only)))
    name = F.concat(F.lit("pageviews-"), F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000.gz"))
    return out.select(F.to_date("ts").alias("date"), F.hour("ts").alias("hour"), name.alias("filename"))


def partition_columns(path: Column) -> list[Column]:
    """date, hour, project, access_mode of a Silver file's path; null where it lies elsewhere."""
    found = F.regexp_extract(path, SILVER_PATH, 0) != ""
    part = lambda k: F.when(found, F.regexp_extract(path, SILVER_PATH, k))
    return [part(1).try_cast("date").alias("date"), part(2).try_cast("int").alias("hour"), part(3).alias("project"), part(4).alias("access_mode")]


def parse_partition(path: str | Path, table: str | Path) -> tuple[str, int, str, str] | None:
    """(date, hour, project, access_mode) of a Silver file, or None."""
    return parse_relative(Path(path).relative_to(table).as_posix())


def parse_relative(path: str) -> tuple[str, int, str, str] | None:
    """The same of a path relative to the table."""
    m = re.fullmatch(SILVER_PATH, path)
    return (m[1], int(m[2]), m[3], m[4]) if m else None
