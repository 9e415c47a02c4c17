"""The command lines that need a session, run on the tests' own."""

import json

import pytest
from test_silver import bronze  # noqa: F401  a fixture

from hourlake.cli import build_silver, validate


@pytest.fixture
def session(spark, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    for module in (build_silver, validate):
        monkeypatch.setattr(module, "create_session", lambda name: spark)


def run(main, capsys, *args):
    code = main([str(a) for a in args])
    return code, capsys.readouterr().out


def test_build_and_validate(session, bronze, capsys):  # noqa: F811
    tables = ["--silver-dir", bronze / "s", "--quarantine-dir", bronze / "q", "--manifest", bronze / "manifest.json", "--source-projects", "en,en.m"]
    code, out = run(build_silver.main, capsys, "--raw-dir", bronze / "Tâm raw", *tables, "--engine", "python", "--rows-per-file", 1)
    summary = json.loads(out)
    assert code == 0 and (summary["silver_rows"], summary["quarantine_rows"]) == (3, 2)
    assert all("malformed_supported_project_line" in p.as_posix() for p in (bronze / "q").rglob("*.parquet"))
    with pytest.raises(FileExistsError):
        build_silver.main([str(a) for a in ["--raw-dir", bronze / "Tâm raw", *tables]])
    code, out = run(validate.main, capsys, *tables, "--full-scan", "--clean-sidecars", "--report", bronze / "report.json")
    assert code == 0 and "sidecar files deleted" in out and json.loads((bronze / "report.json").read_text())["metrics"]["row_count"] == 3
    assert not list((bronze / "s").rglob("_SUCCESS"))
    code, out = run(validate.main, capsys, *tables[:-1], "en,en.m,vi")
    assert code == 1 and json.loads(out)["status"] == "fail"


def test_dry_run(bronze, capsys):  # noqa: F811
    code, out = run(build_silver.main, capsys, "--raw-dir", bronze / "Tâm raw", "--manifest", bronze / "manifest.json", "--silver-dir", bronze / "s", "--dry-run")
    assert code == 0 and json.loads(out)["input_files"] == 1
