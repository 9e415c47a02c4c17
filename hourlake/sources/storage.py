"""Files below a path, on whatever file system its scheme (or, without one, Spark's default) names."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def to_uri(path: str | Path) -> str:
    """A path with a scheme, as Spark takes it (nothing is percent-encoded): those without one become absolute file: paths, others stay."""
    text = str(path)
    return text if "://" in text or text.startswith("file:") else f"file://{Path(text).resolve().as_posix()}"


def local_path(uri: str | Path) -> Path | None:
    """The local path of a path without a scheme or with file:, else None."""
    text = str(uri)
    if "://" not in text and not text.startswith("file:"):
        return Path(text)
    return Path("/" + text.removeprefix("file:").lstrip("/")) if text.startswith("file:") else None


def _at(spark: SparkSession, path: str | Path):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str | Path) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def files(spark: SparkSession, path: str | Path) -> dict[str, int]:
    """Sizes of all files below a folder by their paths relative to it, in order; none where it is absent. Listed on the driver: bounded by files, not rows."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return {}
    top = fs.makeQualified(at).toUri().getPath().rstrip("/")
    if fs.getFileStatus(at).isFile():
        return {"": fs.getFileStatus(at).getLen()}
    if (own := local_path(fs.makeQualified(at).toString())) is not None:  # this file system hides its checksum files
        return {p.relative_to(own).as_posix(): p.stat().st_size for p in sorted(own.rglob("*")) if p.is_file()}
    out, found = {}, fs.listFiles(at, True)
    while found.hasNext():
        status = found.next()
        out[status.getPath().toUri().getPath()[len(top) + 1 :]] = status.getLen()
    return dict(sorted(out.items()))


def delete(spark: SparkSession, path: str | Path) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, path: str | Path, to: str | Path) -> None:
    """Rename within a file system; OSError where it refuses."""
    fs, at = _at(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(to))
    fs.mkdirs(target.getParent())
    if not fs.rename(at, target):
        raise OSError(f"{path} could not be moved to {to}")


def beside(path: str | Path, mark: str) -> str:
    """A hidden neighbour of a path."""
    folder, slash, name = str(path).rstrip("/").rpartition("/")
    return f"{folder}{slash}.{name}.{mark}"
