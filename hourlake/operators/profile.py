"""Profiles of Silver, quarantine and file inventories. Every function is DataFrame to DataFrame; sums and counts pre-aggregate before their shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.sources.schemas import NATURAL_KEY


def totals(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, views and bytes by keys; null keys form groups of their own."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"), F.sum("view_count").alias("total_views"), F.sum("response_size").alias("total_bytes"))


def project_access_totals(silver: DataFrame) -> DataFrame:
    return totals(silver, "project", "access_mode")


def partition_totals(silver: DataFrame, most: int = 50) -> DataFrame:
    """The partitions with most views."""
    keys = ("date", "hour", "project", "access_mode")
    return totals(silver, *keys).orderBy(F.desc("total_views"), *keys).limit(most)


def hourly_project_views(silver: DataFrame) -> DataFrame:
    return silver.groupBy("date", "hour", "project").agg(F.sum("view_count").alias("views"))


def hourly_pivot(silver: DataFrame, projects: Sequence[str]) -> DataFrame:
    """Views by hour with a column for each project, 0 where there are none. The projects are named, so no job looks for them."""
    return silver.groupBy("date", "hour").pivot("project", list(projects)).agg(F.sum("view_count")).na.fill(0)


def top_titles(silver: DataFrame, most: int = 25) -> DataFrame:
    columns = ("date", "hour", "source_project", "page_title", "normalized_title", "view_count")
    return silver.select(*columns).orderBy(F.desc("view_count"), *columns[:5]).limit(most)


def duplicate_keys(silver: DataFrame, key: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Keys that more than one row has; rows with a null in the key do not count. They are left out in the count: a filter would be pushed below the parser and parse twice."""
    whole = reduce(and_, [F.col(c).isNotNull() for c in key])
    return silver.groupBy(*key).agg(F.count(F.when(whole, 1)).alias("n_rows")).where("n_rows > 1")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


def distinct_counts(silver: DataFrame) -> DataFrame:
    """How many dates, hours and partitions there are; counted from the distinct partitions, which are few."""
    parts = silver.select("date", "hour", "project", "access_mode").distinct()
    return parts.agg(F.countDistinct("date").alias("dates"), F.countDistinct("date", "hour").alias("date_hours"), F.count("*").alias("partitions"))


def distinct_pairs(df: DataFrame) -> DataFrame:
    return df.select("project", "access_mode").distinct()


def parse_stats(lines: DataFrame) -> DataFrame:
    """Sampled, parsed and malformed lines of each file."""
    ok = F.col("invalid_reason").isNull()
    return lines.groupBy("source_filename").agg(F.count("*").alias("sampled"), F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("malformed"))


def source_counts(lines: DataFrame) -> DataFrame:
    """Lines of each file by source project; a row for each pair, so that no list grows with the data."""
    return lines.groupBy("source_filename", "source_project").agg(F.count("*").alias("n_lines"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, exact quartiles and extremes of a column."""
    value = F.col(column)
    quarter = lambda p, name: F.percentile(value, F.lit(p)).alias(name)
    return df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("least"),
        quarter(0.25, "q25"), quarter(0.5, "q50"), quarter(0.75, "q75"), F.max(value).alias("most"),
    )


def quality_counts(silver: DataFrame) -> DataFrame:
    """Rows with null or negative values, all counted in one scan."""
    bad = lambda c: F.count_if(c)
    return silver.agg(
        F.count("*").alias("row_count"),
        bad(F.col("page_title").isNull()).alias("null_page_title"),
        bad(F.col("normalized_title").isNull()).alias("null_normalized_title"),
        bad(F.col("view_count").isNull() | (F.col("view_count") < 0)).alias("bad_view_count"),
        bad(F.col("response_size").isNull() | (F.col("response_size") < 0)).alias("bad_response_size"),
    )


def unique_lists(silver: DataFrame) -> DataFrame:
    """The sorted projects and access modes; a small fixed dimension bounds both lists."""
    return silver.agg(F.array_join(F.sort_array(F.collect_set("project")), ",").alias("projects"), F.array_join(F.sort_array(F.collect_set("access_mode")), ",").alias("access_modes"))


def group_count_ordered(silver: DataFrame, most: int = 50) -> DataFrame:
    keys = ("date", "project", "access_mode")
    return silver.groupBy(*keys).agg(F.count("*").alias("n_rows")).orderBy(*keys).limit(most)


def hour_coverage(silver: DataFrame, expected: int) -> DataFrame:
    """Hours whose number of (project, access) partitions is not the expected one."""
    parts = silver.select("date", "hour", "project", "access_mode").distinct()
    return parts.groupBy("date", "hour").agg(F.count("*").alias("partitions")).where(F.col("partitions") != expected)


def first_of_files(df: DataFrame, file: str, order: Column, rows: int, files: int) -> DataFrame:
    """The first rows of the first files by name. Files are chosen first, so that only theirs are sorted."""
    chosen = df.select(file).distinct().orderBy(file).limit(files)
    at = Window.partitionBy(file).orderBy(order)
    return df.join(F.broadcast(chosen), file, "left_semi").withColumn("place", F.row_number().over(at)).where(F.col("place") <= rows)


def inventory(manifest: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer join of manifest and files by name, with where each was found and whether sizes agree (false where either is missing)."""
    left = manifest.select("filename", F.col("size_bytes").alias("size_bytes_manifest"), F.lit(True).alias("in_manifest"))
    right = actual.select("filename", F.col("size_bytes").alias("size_bytes_actual"), F.lit(True).alias("in_actual"))
    out = left.join(right, "filename", "full_outer")
    found = F.when(F.col("in_manifest") & F.col("in_actual"), "both").when(F.col("in_manifest"), "left_only").otherwise("right_only")
    return out.select("filename", "size_bytes_manifest", "size_bytes_actual", found.alias("found"), F.coalesce(F.col("size_bytes_manifest") == F.col("size_bytes_actual"), F.lit(False)).alias("size_matches"))


def inventory_mismatches(joined: DataFrame) -> DataFrame:
    return joined.where((F.col("found") != "both") | ~F.col("size_matches"))


def summary(manifest: DataFrame) -> DataFrame:
    """Files, first and last hour, and size of a manifest; sums of nothing are 0."""
    size = F.coalesce(F.sum("size_bytes"), F.lit(0))
    return manifest.agg(F.count("*").alias("files"), F.min("timestamp_hour").alias("first_hour"), F.max("timestamp_hour").alias("last_hour"), size.alias("total_bytes"), F.round(size / 1024.0 / 1024.0, 2).alias("total_mib"))


def expected_partitions(hours: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each hour with each (project, access) pair: hours times a fixed handful of pairs, which are broadcast."""
    return hours.select("date", "hour").distinct().crossJoin(F.broadcast(pairs.select("project", "access_mode").distinct()))


def missing(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is expected and not there."""
    return expected.select(*keys).distinct().join(actual.select(*keys).distinct(), list(keys), "left_anti")


def extra(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is there and not expected."""
    return missing(actual, expected, keys)


def file_inventory(spark, path: str, names: str = "*.parquet") -> DataFrame:
    """(path, length) of the files below a folder whose names fit, from the listing alone."""
    return spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(str(path)).select("path", "length")


def dump_inventory(spark, path: str) -> DataFrame:
    """(filename, size_bytes) of the dumps below a folder: the listing that `inventory` compares with a manifest."""
    return file_inventory(spark, path, "pageviews-*.gz").select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size_bytes"))


def first_lines(spark, paths: Sequence[str], rows: int) -> DataFrame:
    """(source_filename, line, value) of the first lines of each gzip file. A cut or corrupt file gives the lines before the fault; it does not fail the scan.

    A file is one task, which stops reading once it has its lines; nothing is shuffled or sorted.
    """
    lines = spark.read.option("ignoreCorruptFiles", "true").text(list(map(str, paths))).select(F.col("_metadata.file_name").alias("source_filename"), "value")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            names, at, places = batch.column(0).to_pylist(), [], []
            for k, name in enumerate(names):
                last, n = (last, n + 1) if name == last else (name, 1)
                if n <= rows:
                    at.append(k)
                    places.append(n)
            some = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(places, pa.int32()), some.column(1)], ["source_filename", "line", "value"])

    return lines.mapInArrow(work, "source_filename string, line int, value string")


def first_rows(spark, path: str, rows: int) -> DataFrame:
    """The first rows of each Parquet file below a folder, with its name and the row's place: by the row index that the reader gives, without a shuffle."""
    table = spark.read.option("recursiveFileLookup", "true").parquet(str(path))
    return table.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index")).where(F.col("row_index") < rows)
