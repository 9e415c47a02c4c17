"""Download hourly dumps into a Bronze folder."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from hourlake.config import Settings, configure_logging, csv
from hourlake.sources import manifest
from hourlake.sources.acquire import acquire
from hourlake.sources.names import dump_name, dump_path, hours


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--start-date", type=date.fromisoformat)
    p.add_argument("--end-date", type=date.fromisoformat)
    p.add_argument("--output-dir")
    p.add_argument("--plan")
    p.add_argument("--manifest")
    p.add_argument("--hours", help="comma-separated hours of the day")
    p.add_argument("--base-url", action="append", help="https mirror; may be repeated")
    p.add_argument("--workers", type=int)
    p.add_argument("--attempts", type=int)
    p.add_argument("--timeout-seconds", type=float)
    p.add_argument("--verify-existing", action="store_true", help="hash files that are there, whatever the manifest says")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    return p


def hours_of_day(text: str) -> set[int]:
    """Hours of a comma-separated text; ValueError for one that no day has."""
    out = {int(h) for h in csv(text)}
    if odd := sorted(out - set(range(24))):
        raise ValueError(f"hours of the day are from 0 to 23, not {odd}")
    return out


def main(argv: list[str] | None = None) -> int:
    args, settings = parser().parse_args(argv), Settings.load()
    configure_logging()
    manifest.check_overrides(bool(args.plan), start_date=args.start_date, end_date=args.end_date, output_dir=args.output_dir, hours=args.hours)
    if args.plan:
        plan = manifest.load_plan(args.plan)
    else:
        urls = manifest.mirrors({"base_urls": args.base_url or []})
        start, end = args.start_date or settings.start_date, args.end_date or settings.end_date
        plan = manifest.Plan(f"manual-{start}-{end}", start, end, urls)
    out = args.output_dir or plan.output_dir or settings.raw_dir
    path = args.manifest or plan.manifest_path or f"{out}/manifest.json"
    only = hours_of_day(args.hours) if args.hours else None
    wanted = list(hours(plan.start, plan.end, only))
    workers, attempts = manifest.workers(args.workers or plan.workers), manifest.attempts(args.attempts or plan.attempts)
    timeout = manifest.timeout(args.timeout_seconds or plan.timeout)
    trust = plan.trust_manifest and not args.verify_existing and not args.overwrite
    if args.dry_run:
        existing = sum(dump_path(out, at).exists() for at in wanted)
        scope = {"plan_id": plan.plan_id, "hours": len(wanted), "files": len(wanted), "existing_files": existing, "files_to_download": len(wanted) - existing, "first": dump_name(wanted[0]) if wanted else None, "last": dump_name(wanted[-1]) if wanted else None}
        how = {"download_workers": workers, "download_attempts": attempts, "download_timeout_seconds": timeout, "trust_manifest_on_resume": trust}
        print(json.dumps(scope | how | {"base_urls": list(plan.base_urls), "output_dir": str(out), "manifest_path": str(path)}, indent=2))
        return 0
    failed = acquire(wanted, plan.base_urls, out, path, plan.plan_id, workers, attempts, timeout, args.overwrite, trust)
    for line in failed:
        print(line, file=sys.stderr)
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
