"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm.bpe import forget, release

#: A word, wherever a query counts or shingles words: a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"

#: The setting by which Spark removes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The setting that bounds the bytes of a batch of rows that Spark sends to a Python worker, and the bound: rows of long texts make batches of tens of MB
#: without it, which the JVM holds outside of its heap, and the worker once more, for each task at once.
BATCHES, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20)

_tables: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where the setting is absent and all runs on this machine (tests) a temporary folder takes its place. On a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="hourlake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the driver's process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _tables.append((spark, path))
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority by which Spark resolves it, so that every machine and library means the same place."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return f"file://{full.removeprefix('file:')}" if full.startswith("file:/") and not full.startswith("file://") else full


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a path through the file system that its scheme names."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _tables:
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before
            return


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: Spark removes them as each SQL execution ends. For executions whose result is written or collected."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def result(df: DataFrame, name: str, since: int) -> DataFrame:
    """stored(df), after which the tables that were made from `since` (see mark) on are removed: only for a df that needs no other."""
    made = _tables[since:]
    out = stored(df, name)
    for spark, path in made:
        drop_path(spark, path)
    _tables[since : since + len(made)] = []
    return out


def mark() -> int:
    """How many tables of the shared folder there are so far."""
    return len(_tables)


def lean(spark: SparkSession) -> None:
    """Have what this session runs from now on send rows to Python workers in batches of BATCH bytes, unless it has a smaller bound."""
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCHES)) > int(BATCH):
        spark.conf.set(BATCHES, BATCH)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df has not, so that added columns never clash."""
    taken = {c.lower() for c in df.columns}
    out, n = name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of a table of the input folder."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def alone(work: Callable) -> Callable:
    """`work` on batches, before which its Python worker empties the memos that tasks of other operators have left in it, and after which it gives back what it has used."""

    def run(batches: Iterator) -> Iterator:
        forget()
        yield from work(batches)
        release()

    return run


def text_or_empty(column: str = "text"):
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
