"""Bronze to Silver: scan, classify, split, and guarded writes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.lines import classified, normalized_title
from hourlake.functions.projects import DEFAULT_CODES, dimension
from hourlake.sources import schemas, storage


def raw_lines(spark: SparkSession, paths: Iterable[str | Path]) -> DataFrame:
    """(value, source_file, source_filename) of the lines of gzip files. A gzip file is one task; bytes that are no UTF-8 become U+FFFD."""
    paths = [storage.to_uri(p) for p in paths]
    if not paths:
        raise ValueError("no input files")
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("source_filename"))


def in_scope(raw: DataFrame, codes: Iterable[str]) -> DataFrame:
    """Lines whose first token is one of the codes; others are dropped without trace."""
    return raw.where(F.substring_index("value", " ", 1).isin(list(codes)))


def silver_rows(lines: DataFrame) -> DataFrame:
    """The valid of the classified lines, as Silver columns."""
    out = lines.where(F.col("invalid_reason").isNull()).withColumn("normalized_title", normalized_title(F.col("page_title")))
    return out.select(*[f.name for f in schemas.SILVER.fields])


def quarantine_rows(lines: DataFrame, python_reasons: bool = False) -> DataFrame:
    """The invalid of the classified lines, as quarantine columns; python_reasons gives every one the single label of line-at-a-time parsers."""
    reason = F.lit("malformed_supported_project_line") if python_reasons else F.col("invalid_reason")
    out = lines.where(F.col("invalid_reason").isNotNull()).withColumn("raw_line", F.col("value")).withColumn("invalid_reason", reason)
    return out.select(*[f.name for f in schemas.QUARANTINE.fields])


def classified_lines(spark: SparkSession, paths: Iterable[str | Path], codes: Iterable[str] = DEFAULT_CODES, out_of_scope: str = "quarantine") -> DataFrame:
    """The classified lines of dump files. out_of_scope says what becomes of lines with other codes: 'quarantine' or 'drop'."""
    if out_of_scope not in ("quarantine", "drop"):
        raise ValueError(f"out_of_scope is quarantine or drop, not {out_of_scope}")
    dim = dimension(spark, codes)
    raw = raw_lines(spark, paths)
    if out_of_scope == "drop":
        raw = in_scope(raw, codes)
    return classified(raw, dim)


def build(spark: SparkSession, paths: Iterable[str | Path], codes: Iterable[str] = DEFAULT_CODES, out_of_scope: str = "quarantine", python_reasons: bool = False) -> tuple[DataFrame, DataFrame]:
    """(Silver, quarantine) frames of dump files."""
    lines = classified_lines(spark, paths, codes, out_of_scope)
    return silver_rows(lines), quarantine_rows(lines, python_reasons)


@dataclass(frozen=True)
class BuildSummary:
    input_files: int
    silver_dir: str
    quarantine_dir: str
    silver_rows: int
    quarantine_rows: int


def has_payload(path: str | Path, spark: SparkSession | None = None) -> bool:
    """Whether any file, even a marker, lies at or below the path. Paths with another scheme than file: need a session."""
    if spark is not None:
        return bool(storage.files(spark, path))
    if (own := storage.local_path(path)) is None:
        raise ValueError(f"{path} can only be listed by a session")
    return own.is_file() or own.is_dir() and any(p.is_file() for p in own.rglob("*"))


def assert_writable(*paths: str | Path, overwrite: bool = False, spark: SparkSession | None = None) -> None:
    if not overwrite and (full := [str(p) for p in paths if has_payload(p, spark)]):
        raise FileExistsError(f"outputs hold files; pass overwrite to replace them: {full}")


def write_tables(silver: DataFrame, quarantine: DataFrame, silver_dir: str | Path, quarantine_dir: str | Path, overwrite: bool = False, rows_per_file: int = 0) -> None:
    """Write both tables beside their places and move them there, so that a failed run leaves the old ones whole.

    The paths may be on any file system that Spark reads. The writes are map-only: one file for each task and partition.
    rows_per_file over 0 bounds a file's rows.
    """
    spark = silver.sparkSession
    assert_writable(silver_dir, quarantine_dir, overwrite=overwrite, spark=spark)
    staged = []
    for frame, path, by in ((silver, silver_dir, schemas.SILVER_PARTITIONS), (quarantine, quarantine_dir, schemas.QUARANTINE_PARTITIONS)):
        aside = storage.beside(path, "staging")
        storage.delete(spark, aside)
        frame.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(aside)
        staged.append((aside, path))
    for aside, path in staged:
        storage.delete(spark, path)
        storage.move(spark, aside, path)


def build_tables(
    spark: SparkSession, paths: Iterable[str | Path], silver_dir: str | Path, quarantine_dir: str | Path, codes: Iterable[str] = DEFAULT_CODES, overwrite: bool = False,
    out_of_scope: str = "quarantine", python_reasons: bool = False, rows_per_file: int = 0, parse_once: bool = True,
) -> BuildSummary:
    """Build and write both tables. Codes, inputs and outputs are checked before anything is deleted.

    With parse_once the classified lines are kept on the executors' disks between the two writes, so that each gzip file is read
    and parsed once; lines of a lost executor are parsed again. Without it each write reads the dumps anew and needs no such room.
    """
    paths = list(paths)
    lines = classified_lines(spark, paths, codes, out_of_scope)
    assert_writable(silver_dir, quarantine_dir, overwrite=overwrite, spark=spark)
    if parse_once:
        lines = lines.persist(StorageLevel.DISK_ONLY)
    try:
        write_tables(silver_rows(lines), quarantine_rows(lines, python_reasons), silver_dir, quarantine_dir, overwrite, rows_per_file)
    finally:
        if parse_once:
            lines.unpersist()
    return BuildSummary(len(paths), str(silver_dir), str(quarantine_dir), read_silver(spark, silver_dir).count(), read_quarantine(spark, quarantine_dir).count())


def read_silver(spark: SparkSession, path: str | Path) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(str(path))


def read_quarantine(spark: SparkSession, path: str | Path) -> DataFrame:
    return spark.read.schema(schemas.QUARANTINE).parquet(str(path))
