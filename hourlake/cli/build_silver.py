"""Build Silver and quarantine tables from the files of a manifest."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from hourlake.config import Settings, configure_logging, csv
from hourlake.functions.projects import allowlist
from hourlake.operators.silver import assert_writable, build_tables, has_payload
from hourlake.sources import storage
from hourlake.sources.manifest import bronze_files
from hourlake.sources.session import create_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--raw-dir")
    p.add_argument("--manifest")
    p.add_argument("--silver-dir")
    p.add_argument("--quarantine-dir")
    p.add_argument("--source-projects")
    p.add_argument("--limit-files", type=int)
    p.add_argument("--rows-per-file", type=int, default=0, help="most rows of a file; 0: no bound")
    p.add_argument("--engine", choices=("spark", "python"), default="spark", help="python: every rejected line gets the one reason of line-at-a-time parsers; the work is the same")
    p.add_argument("--out-of-scope", choices=("quarantine", "drop"), default="quarantine")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args, settings = parser().parse_args(argv), Settings.load()
    configure_logging()
    raw, silver = args.raw_dir or settings.raw_dir, args.silver_dir or settings.silver_dir
    quarantine, path = args.quarantine_dir or f"{silver}_quarantine", args.manifest or f"{raw}/manifest.json"
    codes = allowlist(csv(args.source_projects) if args.source_projects else settings.source_projects)
    files = bronze_files(path, raw, args.limit_files)
    if args.dry_run:
        remote = storage.local_path(silver) is None or storage.local_path(quarantine) is None
        spark = create_session("build-silver") if remote else None
        full = {"silver": has_payload(silver, spark), "quarantine": has_payload(quarantine, spark)}
        print(json.dumps({"raw_dir": raw, "manifest": path, "silver_dir": silver, "quarantine_dir": quarantine, "source_projects": codes, "input_files": len(files), "input_bytes": sum(f.path.stat().st_size for f in files), "first_file": files[0].filename if files else None, "last_file": files[-1].filename if files else None, "has_payload": full, "overwrite": args.overwrite, "would_refuse_without_overwrite": any(full.values())}, indent=2))
        return 0
    spark = create_session("build-silver")
    try:
        assert_writable(silver, quarantine, overwrite=args.overwrite, spark=spark)
        summary = build_tables(spark, [f.path for f in files], silver, quarantine, codes, args.overwrite, args.out_of_scope, args.engine == "python", args.rows_per_file)
    finally:
        spark.stop()
    print(json.dumps(asdict(summary), indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
