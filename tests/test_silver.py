import gzip
import json
from datetime import date, datetime

import pytest

from hourlake.operators import quality, silver
from hourlake.sources import manifest, names

LINES = b"en Main_Page 10 100\nfr Page_d_accueil 5 50\nen A\nen.m B%5FC 1 2\r\nen \xff 1 2\n"


@pytest.fixture
def bronze(tmp_path):
    at = datetime(2026, 1, 1)
    path = names.dump_path(tmp_path / "Tâm raw", at)
    path.parent.mkdir(parents=True)
    path.write_bytes(gzip.compress(LINES))
    entry = {"filename": path.name, "timestamp_hour": "2026-01-01T00:00:00+00:00", "relative_path": path.relative_to(tmp_path / "Tâm raw").as_posix(), "size_bytes": path.stat().st_size, "sha256": "x", "source_url": "u"}
    manifest.write_manifest(tmp_path / "manifest.json", "p", [entry])
    return tmp_path


def files(bronze):
    return [f.path for f in manifest.bronze_files(bronze / "manifest.json", bronze / "Tâm raw")]


def test_build_and_validate(spark, bronze):
    summary = silver.build_tables(spark, files(bronze), bronze / "silver", bronze / "quarantine", ["en", "en.m", "en"])
    assert (summary.silver_rows, summary.quarantine_rows) == (3, 2)
    rows = silver.read_silver(spark, bronze / "silver").collect()
    assert {(r["date"], r["hour"], r["normalized_title"]) for r in rows} == {(date(2026, 1, 1), 0, t) for t in ("Main Page", "B C", "�")}
    assert (bronze / "silver/date=2026-01-01/hour=0/project=en/access_mode=desktop").is_dir()
    bad = silver.read_quarantine(spark, bronze / "quarantine").collect()
    assert {r["invalid_reason"] for r in bad} == {"unsupported_source_project", "malformed_line"}
    report = quality.validate(spark, bronze / "silver", bronze / "quarantine", bronze / "manifest.json", ["en", "en.m"], full_scan=True)
    assert report.status == "pass" and report.metrics["row_count"] == 3 and report.cleanup_candidates
    assert quality.clean_sidecars(report.cleanup_candidates) == len(report.cleanup_candidates)
    more = quality.validate(spark, bronze / "silver", bronze / "quarantine", bronze / "manifest.json", ["en", "en.m", "vi"])
    assert more.status == "fail" and more.metrics["missing_partitions"] == [("2026-01-01", 0, "vi", "desktop")]
    none = quality.validate(spark, bronze / "silver", bronze / "quarantine", bronze / "no.json", ["en"])
    assert none.status == "pass" and none.metrics["extra_hours"] and not none.metrics["extra_partitions"]
    quality.write_report(report, bronze / "deep/report.json")
    assert json.loads((bronze / "deep/report.json").read_text())["status"] == "pass"


def test_guards(spark, bronze):
    (bronze / "silver").mkdir()
    silver.build_tables(spark, files(bronze), bronze / "silver", bronze / "quarantine", ["en"])  # an empty folder is no payload
    with pytest.raises(FileExistsError):
        silver.build_tables(spark, files(bronze), bronze / "silver", bronze / "quarantine", ["en"])
    with pytest.raises(ValueError):  # codes are checked before anything goes
        silver.build_tables(spark, files(bronze), bronze / "silver", bronze / "quarantine", ["xx"], overwrite=True)
    assert silver.has_payload(bronze / "silver")
    dropped = silver.build_tables(spark, files(bronze), bronze / "silver", bronze / "quarantine", ["en"], overwrite=True, out_of_scope="drop")
    assert (dropped.silver_rows, dropped.quarantine_rows) == (2, 1)
    with pytest.raises(ValueError):
        silver.raw_lines(spark, [])
    with pytest.raises(ValueError):
        quality.clean_sidecars([bronze / "manifest.json"])


def test_stream(spark, bronze):
    from hourlake.streaming.silver_stream import start

    query = start(spark, str(bronze / "Tâm raw"), str(bronze / "s"), str(bronze / "q"), str(bronze / "c"), ["en"])
    query.awaitTermination()
    assert silver.read_silver(spark, bronze / "s").count() == 2
    report = quality.validate(spark, bronze / "s", bronze / "q", bronze / "manifest.json", ["en"], full_scan=True)
    assert report.status == "pass" and report.metrics["row_count"] == 2


def test_a_repeated_batch_replaces_its_files(spark, tmp_path):
    from hourlake.streaming.silver_stream import put

    for rows in (3, 2):
        spark.range(rows).selectExpr("id", "id % 2 as k").coalesce(1).write.mode("overwrite").partitionBy("k").parquet(str(tmp_path / "aside"))
        put(spark, str(tmp_path / "aside"), str(tmp_path / "t"), "batch-1-")
    put_in = spark.read.parquet(str(tmp_path / "t"))
    assert put_in.count() == 2 and not (tmp_path / "aside").exists()


def test_uris_and_options(spark, bronze):
    to = [(bronze / n).as_uri() for n in ("s", "q")]
    summary = silver.build_tables(spark, files(bronze), *to, ["en"], python_reasons=True, rows_per_file=1, parse_once=False)
    assert (summary.silver_rows, summary.quarantine_rows) == (2, 3)
    assert len([p for p in (bronze / "s").rglob("*.parquet")]) == 2
    assert {r["invalid_reason"] for r in silver.read_quarantine(spark, to[1]).collect()} == {"malformed_supported_project_line"}
    assert silver.has_payload(to[0]) and silver.has_payload(to[0], spark)
    with pytest.raises(FileExistsError):
        silver.build_tables(spark, files(bronze), *to, ["en"])
    assert quality.validate(spark, *to, bronze / "manifest.json", ["en"], full_scan=True).status == "pass"
    with pytest.raises(ValueError):
        silver.has_payload("s3://bucket/table")


def test_samples_and_listing(spark, bronze):
    from hourlake.operators import profile

    (path,) = files(bronze)
    cut = path.with_name("pageviews-20260101-010000.gz")
    cut.write_bytes(path.read_bytes()[:-12])
    lines = profile.first_lines(spark, [path, cut], 2).collect()
    assert [(r["line"], r["value"]) for r in lines if r["source_filename"] == path.name] == [(1, "en Main_Page 10 100"), (2, "fr Page_d_accueil 5 50")]
    actual = profile.dump_inventory(spark, str(bronze / "Tâm raw"))
    joined = profile.inventory(manifest.manifest_frame(spark, bronze / "manifest.json"), actual).collect()
    assert {(r["filename"], r["found"], r["size_matches"]) for r in joined} == {(path.name, "both", True), (cut.name, "right_only", False)}
    silver.build_tables(spark, [path], bronze / "s", bronze / "q", ["en"])
    rows = profile.first_rows(spark, str(bronze / "s"), 1).collect()
    assert len(rows) == 1 and rows[0]["row_index"] == 0


def test_missing_tables(spark, tmp_path):
    report = quality.validate(spark, tmp_path / "no", tmp_path / "none", tmp_path / "no.json", ["en"], full_scan=True)
    assert report.status == "fail" and any("missing" in e for e in report.errors)
    with pytest.raises(KeyError):
        quality.expected_pairs(["xx"])
