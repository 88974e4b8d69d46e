"""Results for new files only: a stream of image files, each batch handled once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartolink.functions.text import IMAGE_TYPES

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def process_new(spark: SparkSession, folder: str, handle: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run ``handle`` on the files that no earlier run has seen and append what it returns.

    A batch's output goes to a folder of its number, so a batch that runs again
    after a failure replaces its own output and nothing is doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        handle(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    files = spark.readStream.format("binaryFile").schema(FILE).load(folder).where(F.lower("path").rlike(IMAGE_TYPES))
    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
