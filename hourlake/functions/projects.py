"""The project dimension: what a source project code stands for."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Project(NamedTuple):
    project: str
    language: str | None
    project_family: str
    access_mode: str


# Supported codes. They are listed, not derived: commons.m is a desktop site.
PROJECTS = {
    "en": Project("en", "en", "wikipedia", "desktop"),
    "en.m": Project("en", "en", "wikipedia", "mobile"),
    "vi": Project("vi", "vi", "wikipedia", "desktop"),
    "vi.m": Project("vi", "vi", "wikipedia", "mobile"),
    "commons.m": Project("commons", None, "commons", "desktop"),
    "commons.m.m": Project("commons", None, "commons", "mobile"),
    "www.wd": Project("wikidata", None, "wikidata", "desktop"),
    "www.wd.m": Project("wikidata", None, "wikidata", "mobile"),
}
#: The codes in scope where nothing else is said: all but the mobile site of wikidata.
DEFAULT_CODES = ("en", "en.m", "vi", "vi.m", "commons.m", "commons.m.m", "www.wd")


def allowlist(codes: Iterable[str]) -> list[str]:
    """Distinct codes in order; ValueError if one is not supported."""
    kept = list(dict.fromkeys(codes))
    if unknown := sorted(set(kept) - set(PROJECTS)):
        raise ValueError(f"unsupported source projects: {unknown}")
    return kept


def dimension(spark: SparkSession, codes: Iterable[str] = DEFAULT_CODES) -> DataFrame:
    """(source_project, project, language, project_family, access_mode), a row for each code, of constants alone; ValueError for none."""
    kept = allowlist(codes)
    if not kept:
        raise ValueError("no source projects")
    text = lambda v, n: F.lit(v).cast("string").alias(n)
    rows = [F.struct(text(code, "source_project"), *[text(v, n) for n, v in PROJECTS[code]._asdict().items()]) for code in kept]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("d")).select("d.*")


def family_or_other(family: Column) -> Column:
    return F.coalesce(family, F.lit("other"))
