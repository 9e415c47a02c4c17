"""Silver as a stream: an addition of this engine. New dump files in a folder are classified as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourlake.functions.lines import classified
from hourlake.functions.projects import DEFAULT_CODES, dimension
from hourlake.operators.silver import quarantine_rows, silver_rows
from hourlake.sources import storage
from hourlake.sources.schemas import QUARANTINE_PARTITIONS, SILVER_PARTITIONS


def put(spark: SparkSession, aside: str, table: str, prefix: str) -> None:
    """Move the Parquet files below `aside` into the table's partitions under names with a prefix; files of such names that are there go first."""
    for path in storage.files(spark, table):
        if path.rpartition("/")[2].startswith(prefix):
            storage.delete(spark, f"{table}/{path}")
    for path in storage.files(spark, aside):
        folder, _, name = path.rpartition("/")
        if name.endswith(".parquet") and not name.startswith((".", "_")):
            storage.move(spark, f"{aside}/{path}", f"{table}/{folder}/{prefix}{name}")
    storage.delete(spark, aside)


def start(spark: SparkSession, folder: str, silver_dir: str, quarantine_dir: str, checkpoint: str, codes=DEFAULT_CODES, files_per_batch: int = 64, once: bool = True) -> StreamingQuery:
    """Append every new file's rows to both tables, in their usual layout. A batch that is repeated after a failure replaces what it had written: its
    files are named after it."""
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").option("pathGlobFilter", "pageviews-*.gz").text(folder)
    lines = lines.select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("source_filename"))

    def write(batch: DataFrame, number: int) -> None:
        known = classified(batch, dimension(batch.sparkSession, codes)).persist()
        try:
            for frame, path, by in ((silver_rows(known), silver_dir, SILVER_PARTITIONS), (quarantine_rows(known), quarantine_dir, QUARANTINE_PARTITIONS)):
                aside = storage.beside(path, f"batch-{number}")
                frame.write.mode("overwrite").partitionBy(*by).parquet(aside)
                put(batch.sparkSession, aside, path, f"batch-{number}-")
        finally:
            known.unpersist()

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
