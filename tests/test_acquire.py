import gzip
import io
import json
from datetime import date, datetime

import pytest

from hourlake.config import Settings, csv
from hourlake.sources import acquire, manifest, names


class Reply(io.BytesIO):
    def __init__(self, data, length=None):
        super().__init__(data)
        self.headers = {"Content-Length": str(len(data) if length is None else length)}


DATA = gzip.compress(b"en Main_Page 1 10\n")
HOURS = [datetime(2026, 1, 1, h) for h in (0, 1)]


def test_names():
    assert names.parse_dump_name("pageviews-20260101-230000.gz") == ("2026-01-01", 23)
    with pytest.raises(ValueError):
        names.parse_dump_name("pageviews-20260101-233000.gz")
    assert names.dump_url(HOURS[1], "https://x/") == "https://x/2026/2026-01/pageviews-20260101-010000.gz"
    assert len(list(names.hours(date(2026, 1, 1), date(2026, 1, 7)))) == 168
    assert [h.hour for h in names.hours(date(2026, 1, 1), date(2026, 1, 1), {3, 5})] == [3, 5]
    assert names.parse_partition("t/date=2026-01-01/hour=0/project=en/access_mode=mobile/a.parquet", "t") == ("2026-01-01", 0, "en", "mobile")
    assert names.parse_partition("t/x/a.parquet", "t") is None


def test_mirror_takes_over_and_manifest_is_kept(tmp_path):
    seen = []

    def opener(url, timeout):
        seen.append(url)
        if url.startswith("https://bad"):
            raise OSError("down")
        return Reply(DATA)

    args = (HOURS, ("https://bad", "https://good"), tmp_path / "raw", tmp_path / "m.json", "p")
    assert acquire.acquire(*args, workers=1, opener=opener, sleep=lambda s: None) == []
    entries = manifest.load_manifest(tmp_path / "m.json")
    assert len(entries) == 2 and all(e["source_url"].startswith("https://good") for e in entries.values())
    n = len(seen)
    assert acquire.acquire(*args, workers=1, opener=opener, sleep=lambda s: None) == [] and len(seen) == n  # nothing anew


@pytest.mark.parametrize("reply", [Reply(b""), Reply(DATA, 5), Reply(DATA[:-6])])
def test_bad_replies_fail(tmp_path, reply):
    failed = acquire.acquire(HOURS[:1], ("https://a",), tmp_path, tmp_path / "m.json", "p", attempts=1, opener=lambda u, timeout: reply)
    assert len(failed) == 1 and not list(tmp_path.rglob("*.gz"))


def test_changed_file_fails(tmp_path):
    manifest.write_manifest(tmp_path / "m.json", "p", [{"filename": names.dump_name(HOURS[0]), "sha256": "other", "size_bytes": 1, "relative_path": "x"}])
    assert acquire.acquire(HOURS[:1], ("https://a",), tmp_path, tmp_path / "m.json", "p", attempts=1, opener=lambda u, timeout: Reply(DATA))


def plan(tmp_path, **more):
    doc = {"plan_id": "p", "start_date": "2026-01-01", "end_date": "2026-01-01", "base_urls": ["https://a/", "https://a", "https://b"]} | more
    (tmp_path / "plan.json").write_text(json.dumps(doc), encoding="utf-8-sig")
    return tmp_path / "plan.json"


def test_plan(tmp_path):
    assert manifest.load_plan(plan(tmp_path, expected_hours=24)).base_urls == ("https://a", "https://b")
    for bad in ({"expected_hours": 23}, {"end_date": "2025-12-31"}, {"base_urls": ["http://a"]}, {"base_urls": "https://a"}, {"download_workers": 9}, {"download_attempts": 0}, {"download_timeout_seconds": 1}):
        with pytest.raises(ValueError):
            manifest.load_plan(plan(tmp_path, **bad))
    for none in ({"base_urls": []}, {"base_urls": None}):  # the official site
        assert manifest.load_plan(plan(tmp_path, **none)).base_urls == (manifest.OFFICIAL_URL,)
    with pytest.raises(ValueError):
        manifest.check_overrides(True, hours="1")
    assert manifest.rotated(("a", "b", "c"), 4) == ("b", "c", "a")


def test_bronze_files(tmp_path, spark):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.gz").write_bytes(DATA)

    def write(*entries):
        (tmp_path / "m.json").write_text(json.dumps({"files": entries}))

    one = {"filename": "a.gz", "relative_path": "a.gz"}
    write(one)
    assert [f.filename for f in manifest.bronze_files(tmp_path / "m.json", tmp_path / "raw", 1)] == ["a.gz"]
    assert manifest.manifest_frame(spark, tmp_path / "m.json").count() == 1
    for entries, error in (([one, one], ValueError), ([{"filename": "e", "relative_path": "../escape.gz"}], ValueError), ([{"filename": "b", "relative_path": "b.gz"}], FileNotFoundError)):
        write(*entries)
        with pytest.raises(error):
            manifest.bronze_files(tmp_path / "m.json", tmp_path / "raw")
    with pytest.raises(ValueError):
        manifest.bronze_files(tmp_path / "m.json", tmp_path / "raw", 0)


def test_settings():
    assert csv(" a, ,b ") == ["a", "b"]
    assert Settings.load({"HOURLAKE_SOURCE_PROJECTS": "en, vi"}).source_projects == ("en", "vi")
    with pytest.raises(ValueError):
        Settings.load({"HOURLAKE_END_DATE": "2020-01-01"})


def test_command_lines(tmp_path, capsys):
    from hourlake.cli import build_silver, download

    assert download.main(["--plan", str(plan(tmp_path)), "--dry-run"]) == 0
    shown = json.loads(capsys.readouterr().out)
    assert shown["files"] == shown["hours"] == shown["files_to_download"] == 24 and shown["trust_manifest_on_resume"] is False
    assert shown["base_urls"] == ["https://a", "https://b"] and shown["download_timeout_seconds"] == 30
    trusting = ["--plan", str(plan(tmp_path, trust_manifest_on_resume=True)), "--dry-run"]
    for more, trust in ([], True), (["--verify-existing"], False), (["--overwrite"], False):
        assert download.main(trusting + more) == 0
        assert json.loads(capsys.readouterr().out)["trust_manifest_on_resume"] is trust
    days = ["--start-date", "2026-01-01", "--end-date", "2026-01-02", "--output-dir", str(tmp_path), "--dry-run"]
    assert download.main([*days, "--hours", "0,23"]) == 0
    shown = json.loads(capsys.readouterr().out)
    assert shown["hours"] == 4 and shown["base_urls"] == [manifest.OFFICIAL_URL] and shown["plan_id"] == "manual-2026-01-01-2026-01-02"
    with pytest.raises(ValueError):
        download.main([*days, "--hours", "24"])
    (tmp_path / "manifest.json").write_text('{"files": []}')
    assert build_silver.main(["--raw-dir", str(tmp_path), "--silver-dir", str(tmp_path / "s"), "--dry-run"]) == 0
    assert json.loads(capsys.readouterr().out)["would_refuse_without_overwrite"] is False
