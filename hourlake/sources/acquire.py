"""Bounded download of hourly dumps, on the driver."""

from __future__ import annotations

import gzip
import hashlib
import os
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from datetime import datetime
from pathlib import Path

from hourlake.sources.manifest import in_scope, load_manifest, rotated, write_manifest
from hourlake.sources.names import dump_folder, dump_name, dump_path

CHUNK = 1 << 20
#: Seconds to wait after a failed attempt, times its number.
BACKOFF = 2.0
#: What a failed attempt may raise; a cut or corrupt gzip file is among them.
FAILURES = (urllib.error.URLError, TimeoutError, RuntimeError, OSError, EOFError, zlib.error)


def sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def check_gzip(path: str | Path) -> None:
    """Decompress a whole file; raises where it is cut or corrupt."""
    with gzip.open(path, "rb") as f:
        while f.read(CHUNK):
            pass


def download(url: str, to: str | Path, timeout: float = 30.0, overwrite: bool = False, known: dict | None = None, opener: Callable = urllib.request.urlopen) -> tuple[bool, int, str]:
    """(downloaded, size, sha256). A file that is there and not empty is kept: its known hash is trusted if the size agrees, else it is hashed."""
    to = Path(to)
    if not overwrite and to.is_file() and (size := to.stat().st_size):
        trusted = known and known.get("size_bytes") == size and known.get("sha256")
        return False, size, trusted or sha256(to)
    to.parent.mkdir(parents=True, exist_ok=True)
    aside = to.with_name(to.name + ".part")
    try:
        with opener(url, timeout=timeout) as reply, open(aside, "wb") as out:
            length = reply.headers.get("Content-Length")
            while data := reply.read(CHUNK):
                out.write(data)
        size = aside.stat().st_size
        if not size or length is not None and int(length) != size:
            raise RuntimeError(f"{url}: {size} bytes came of {length or 'some'}")
        check_gzip(aside)
        digest = sha256(aside)
        os.replace(aside, to)
    finally:
        aside.unlink(missing_ok=True)
    return True, size, digest


def with_retries(urls: Sequence[str], fetch: Callable[[str], tuple], attempts: int, backoff: float = BACKOFF, sleep: Callable = time.sleep) -> tuple[str, tuple]:
    """(url, result) of the first attempt that succeeds; each takes the next mirror; the last failure is raised."""
    for k in range(1, attempts + 1):
        url = urls[(k - 1) % len(urls)]
        try:
            return url, fetch(url)
        except FAILURES:
            if k == attempts:
                raise
            sleep(backoff * k)
    raise ValueError("attempts is 1 at least")


def acquire(
    hours: Sequence[datetime], base_urls: tuple[str, ...], output_dir: str | Path, manifest_path: str | Path, plan_id: str, workers: int = 4, attempts: int = 3,
    timeout: float = 30.0, overwrite: bool = False, trust: bool = False, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep,
) -> list[str]:
    """Download dumps with a pool of threads, keeping the manifest current after each; returns what failed.

    With `trust` a file that is there with the size that the manifest says is not hashed again. A file whose hash is not what the manifest says
    has changed where it must not, and counts as failed.
    """
    entries = in_scope(load_manifest(manifest_path), map(dump_name, hours))
    failed = []

    def one(k: int, at: datetime) -> dict:
        name, path = dump_name(at), dump_path(output_dir, at)
        known = entries.get(name)
        urls = [f"{u}/{dump_folder(at)}/{name}" for u in rotated(base_urls, k)]
        url, (new, size, digest) = with_retries(urls, lambda u: download(u, path, timeout, overwrite, known if trust else None, opener), attempts, sleep=sleep)
        if known and known.get("sha256") and known["sha256"] != digest:
            raise RuntimeError(f"{name} is not what the manifest says")
        source = url if new or not known else known.get("source_url", url)
        return {"filename": name, "timestamp_hour": at.strftime("%Y-%m-%dT%H:00:00+00:00"), "relative_path": path.relative_to(output_dir).as_posix(), "source_url": source, "size_bytes": size, "sha256": digest}

    with ThreadPoolExecutor(workers) as pool:
        jobs = {pool.submit(one, k, at): at for k, at in enumerate(hours)}
        for job in as_completed(jobs):
            try:
                entry = job.result()
            except FAILURES as e:
                failed.append(f"{dump_name(jobs[job])}: {e}")
                continue
            entries[entry["filename"]] = entry
            write_manifest(manifest_path, plan_id, entries.values())
    return failed
