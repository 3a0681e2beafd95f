"""Documents as they arrive: each micro-batch goes through the same operators as a batch run.

A document arrives whole, so there is no state across batches and no watermark; a batch that is run again after a
failure overwrites its own folder, so every document is stored once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest_stream(spark: SparkSession, path: str, schema: str, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Parquet files of decoded rows below path, all that are there now, through `transform` into out/batch=N."""

    def write(batch: DataFrame, n: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={n}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
