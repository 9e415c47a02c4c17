import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path(os.environ.get("HOURLAKE_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from hourlake.sources.session import create_session

    options = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    session = create_session("tests", "local[4]", **options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """Rows of DuckDB SQL over the tables of a scale."""
    import duckdb

    def run(sql: str, sf: str):
        con = duckdb.connect()
        con.execute("set TimeZone = 'UTC'")
        for path in (DATA / sf).glob("*.parquet"):
            con.execute(f"create view {path.stem} as select * from '{path}'")
        out = con.execute(sql)
        return [c[0] for c in out.description], out.fetchall()

    return run


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if hasattr(value, "isoformat") else value


def as_sets(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def same():
    """Asserts that two (columns, rows) results hold the same, whatever the order."""

    def check(left, right):
        assert sorted(left[0]) == sorted(right[0])
        assert as_sets(*left) == as_sets(*right)

    return check
