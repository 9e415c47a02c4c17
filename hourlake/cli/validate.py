"""Validate a Silver table."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from hourlake.config import Settings, configure_logging, csv
from hourlake.operators.quality import clean_sidecars, validate, write_report
from hourlake.sources.session import create_session

#: Clean-up candidates that the printed report names.
SHOWN = 10


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--silver-dir")
    p.add_argument("--quarantine-dir")
    p.add_argument("--manifest")
    p.add_argument("--source-projects")
    p.add_argument("--report")
    p.add_argument("--full-scan", action="store_true")
    p.add_argument("--clean-sidecars", action="store_true")
    p.add_argument("--show-cleanup-candidates", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args, settings = parser().parse_args(argv), Settings.load()
    configure_logging()
    silver = args.silver_dir or settings.silver_dir
    codes = csv(args.source_projects) if args.source_projects else settings.source_projects
    spark = create_session("validate-silver")
    try:
        report = validate(spark, silver, args.quarantine_dir or f"{silver}_quarantine", args.manifest or f"{settings.raw_dir}/manifest.json", codes, args.full_scan)
        cleaned = clean_sidecars(report.cleanup_candidates, spark) if args.clean_sidecars else None
    finally:
        spark.stop()
    if args.report:
        write_report(report, args.report)
    shown = asdict(report)
    if not args.show_cleanup_candidates:
        shown["cleanup_candidates"] = shown["cleanup_candidates"][:SHOWN]
    print(json.dumps(shown, indent=2, ensure_ascii=False))
    if cleaned is not None:
        print(f"{cleaned} sidecar files deleted")
    return int(report.status != "pass")


if __name__ == "__main__":
    sys.exit(main())
