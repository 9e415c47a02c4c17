"""Fixed schemas. Tables are read back with these, never by inference."""

from __future__ import annotations

from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


SILVER = _schema(
    ("date", DateType(), True),
    ("hour", IntegerType(), True),
    ("source_project", StringType(), True),
    ("project", StringType(), True),
    ("language", StringType(), True),
    ("project_family", StringType(), True),
    ("access_mode", StringType(), True),
    ("page_title", StringType(), True),
    ("normalized_title", StringType(), True),
    ("view_count", LongType(), True),
    ("response_size", LongType(), True),
    ("source_filename", StringType(), True),
)
SILVER_PARTITIONS = ("date", "hour", "project", "access_mode")

QUARANTINE = _schema(
    ("date", DateType(), True),
    ("hour", IntegerType(), True),
    *((name, StringType(), True) for name in ("source_project", "page_title", "view_count_raw", "response_size_raw", "invalid_reason", "raw_line", "source_file", "source_filename")),
)
QUARANTINE_PARTITIONS = ("date", "hour", "invalid_reason")

MANIFEST_FILE = _schema(
    ("filename", StringType(), True),
    ("timestamp_hour", StringType(), True),
    ("relative_path", StringType(), True),
    ("source_url", StringType(), True),
    ("size_bytes", LongType(), True),
    ("sha256", StringType(), True),
)

NATURAL_KEY = ("date", "hour", "source_project", "page_title")
#: Columns without which a Silver table is not one (language may be absent); one of LINEAGE should be there.
REQUIRED = tuple(f.name for f in SILVER.fields if f.name not in ("language", "source_filename"))
LINEAGE = ("source_file", "source_filename")
