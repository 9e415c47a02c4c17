import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from hourlake.functions import lines, projects

GOOD = "pageviews-20260101-000000.gz"
CASES = [
    ("en Main_Page 10 100", GOOD, None),
    ("en A 1", GOOD, "malformed_line"),
    ("en", GOOD, "malformed_line"),
    ("", GOOD, "malformed_line"),
    ("en A 1 2 x", GOOD, "malformed_line"),
    ("en  1 2", GOOD, "missing_required_value"),
    ("en A x 2", GOOD, "non_numeric_metric"),
    ("en A 1.5 2", GOOD, "non_numeric_metric"),
    ("en A 1_0 2", GOOD, "non_numeric_metric"),
    ("en A 9223372036854775808 2", GOOD, "non_numeric_metric"),
    ("en A -1 2", GOOD, "negative_metric"),
    ("fr A 1 2", GOOD, "unsupported_source_project"),
    ("www.wd.m Q1 3 4", GOOD, "unsupported_source_project"),
    ("en A 1 2", "pageviews-20260101-003000.gz", "invalid_filename"),
    ("en A 1 2", "pageviews-20261399-000000.gz", "invalid_filename"),
    ("en A 1 2", "pageviews-20260101-990000.gz", "invalid_filename"),
    ("en A 1 2", "", "invalid_filename"),
]


def test_reasons(spark):
    raw = spark.createDataFrame([(v, f"file:/{n}", n, r) for v, n, r in CASES], "value string, source_file string, source_filename string, want string")
    for row in lines.classified(raw, projects.dimension(spark)).select("value", "want", "invalid_reason").collect():
        assert row["invalid_reason"] == row["want"], row["value"]


@pytest.mark.parametrize("title, want", [("A_B", "A B"), ("A%5FB", "A B"), ("C%2B%2B", "C++"), ("A+B", "A+B"), ("100%", "100%"), ("%41%zz", "A%zz"), ("%C3%A9", "é")])
def test_titles(spark, title, want):
    assert spark.range(1).select(lines.normalized_title(F.lit(title))).first()[0] == want


def test_titles_as_unquote(spark):
    rnd = random.Random(3)
    parts = ["a", "_", "+", "%", "%4", "%41", "%c3%a9", "%zz", "é", "%2B", "%25", " ", "%%", "%e2%82%ac"]
    titles = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    for row in df.select("t", lines.normalized_title(F.col("t")).alias("n")).collect():
        assert row["n"] == unquote(row["t"]).replace("_", " ")


def test_allowlist(spark):
    assert projects.allowlist(["en", "vi.m", "en"]) == ["en", "vi.m"]
    with pytest.raises(ValueError, match="xx"):
        projects.allowlist(["en", "xx"])
    with pytest.raises(ValueError):
        projects.dimension(spark, [])
    assert projects.dimension(spark, ["vi.m", "commons.m"]).collect() == [("vi.m", "vi", "vi", "wikipedia", "mobile"), ("commons.m", "commons", None, "commons", "desktop")]
    assert set(projects.DEFAULT_CODES) == set(projects.PROJECTS) - {"www.wd.m"} and "zz" not in projects.PROJECTS
