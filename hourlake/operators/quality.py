"""Validation of a Silver table: layout, coverage, schema, row quality, left-over files."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from hourlake.functions.projects import PROJECTS
from hourlake.operators.profile import quality_counts
from hourlake.sources import storage
from hourlake.sources.manifest import load_json
from hourlake.sources.names import parse_relative
from hourlake.sources.schemas import LINEAGE, REQUIRED


@dataclass(frozen=True)
class Report:
    generated_at_utc: str
    silver_dir: str
    quarantine_dir: str
    manifest_path: str
    status: str
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)
    cleanup_candidates: list[str] = field(default_factory=list)


def parquet_files(spark: SparkSession, path: str | Path) -> dict[str, int]:
    """Sizes of the Parquet files below a folder by their relative paths."""
    return {p: n for p, n in storage.files(spark, path).items() if p.endswith(".parquet")}


def sidecars(spark: SparkSession, path: str | Path) -> list[str]:
    """Markers and checksums that a writer leaves beside its data."""
    return [f"{path}/{p}" for p in storage.files(spark, path) if p and _is_sidecar(p)]


def _is_sidecar(path: str | Path) -> bool:
    name = str(path).rpartition("/")[2]
    return name == "_SUCCESS" or name.endswith(".crc")


def clean_sidecars(paths: list[str | Path], spark: SparkSession | None = None) -> int:
    """Delete sidecars; ValueError for anything else, before any is deleted. Other file systems than the local one need a session."""
    if odd := [str(p) for p in paths if not _is_sidecar(p)]:
        raise ValueError(f"not sidecar files: {odd}")
    for p in paths:
        if (own := storage.local_path(p)) is not None:
            own.unlink(missing_ok=True)
        elif spark is None:
            raise ValueError(f"{p} can only be deleted by a session")
        else:
            storage.delete(spark, p)
    return len(paths)


def expected_hours(manifest_path: str | Path) -> set[tuple[str, int]]:
    """(date, hour) of the manifest's entries, in the offset that each states; empty without a manifest."""
    if not Path(manifest_path).exists():
        return set()
    stamps = (e.get("timestamp_hour") for e in load_json(manifest_path).get("files", []))
    at = [datetime.fromisoformat(s.replace("Z", "+00:00")) for s in stamps if s]
    return {(t.strftime("%Y-%m-%d"), t.hour) for t in at}


def expected_pairs(codes) -> set[tuple[str, str]]:
    """(project, access mode) of codes; KeyError for one that is not supported."""
    return {(PROJECTS[c].project, PROJECTS[c].access_mode) for c in codes}


def validate(spark: SparkSession, silver_dir: str | Path, quarantine_dir: str | Path, manifest_path: str | Path, codes, full_scan: bool = False) -> Report:
    """Check a Silver table against manifest and codes. Without a manifest nothing can be missing and every hour is extra.

    The layout is read from file names on the driver, as it is bounded by files and not rows; row checks are one Spark scan.
    """
    pairs = expected_pairs(codes)
    errors, warnings = [], []
    files, quarantined = parquet_files(spark, silver_dir), parquet_files(spark, quarantine_dir)
    if not storage.exists(spark, silver_dir):
        errors.append(f"Silver directory is missing: {silver_dir}")
    elif not files:
        errors.append("Silver has no Parquet files")
    places = {p: parse_relative(p) for p in files}
    if outside := [p for p, at in places.items() if at is None]:
        errors.append(f"{len(outside)} files lie outside the partition layout")
    parts = {at for at in places.values() if at}
    hours, wanted_hours = {at[:2] for at in parts}, expected_hours(manifest_path)
    wanted = {(*h, *p) for h in wanted_hours for p in pairs}
    lost_hours, more_hours = sorted(wanted_hours - hours), sorted(hours - wanted_hours)
    lost, more = sorted(wanted - parts), sorted(parts - wanted) if wanted_hours else []
    for found, into, what in ((lost_hours, errors, "manifest hours are missing from Silver"), (more_hours, warnings, "hours are not in the manifest"), (lost, errors, "expected partitions are missing"), (more, warnings, "partitions are not expected")):
        if found:
            into.append(f"{len(found)} {what}")
    metrics = {
        "silver_parquet_files": len(files),
        "silver_bytes": sum(files.values()),
        "quarantine_parquet_files": len(quarantined),
        "quarantine_bytes": sum(quarantined.values()),
        "dates": len({at[0] for at in parts}),
        "hours": len(hours),
        "partitions": len(parts),
        "expected_hours": len(wanted_hours),
        "expected_partitions": len(wanted),
        "missing_hours": lost_hours,
        "extra_hours": more_hours,
        "missing_partitions": lost,
        "extra_partitions": more,
    }
    if files:
        table = spark.read.parquet(str(silver_dir))
        if absent := [c for c in REQUIRED if c not in table.columns]:
            errors.append(f"required columns are missing: {absent}")
        if not set(LINEAGE) & set(table.columns):
            warnings.append("no lineage column")
        metrics["columns"] = sorted(table.columns)
        if full_scan and not absent:
            counts = quality_counts(table).first().asDict()
            metrics["row_count"] = counts.pop("row_count")
            metrics["bad_rows"] = counts
            errors += [f"{n} rows with {name}" for name, n in counts.items() if n]
    if not (full_scan and files):
        warnings.append("rows were not scanned")
    left = [p for d in (silver_dir, quarantine_dir) for p in sidecars(spark, d)]
    if left:
        warnings.append(f"{len(left)} sidecar files")
    return Report(datetime.now(UTC).isoformat(), str(silver_dir), str(quarantine_dir), str(manifest_path), "fail" if errors else "pass", errors, warnings, metrics, left)


def write_report(report: Report, path: str | Path) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(asdict(report), indent=2, ensure_ascii=False) + "\n", encoding="utf-8")

