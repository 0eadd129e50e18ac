"""Files that arrive in a folder, curated batch by batch with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltworks.plans.pipeline import Store


def curate_stream(spark: SparkSession, folder: str, schema: StructType, adapter: Callable[[DataFrame], DataFrame], store: Store, checkpoint: str, max_files: int = 5, fmt: str = "parquet", once: bool = True) -> StreamingQuery:
    """Each micro-batch of new files is one batch of the store, named by its number.

    A batch that was committed before a failure is skipped when the stream tries it again, so
    every file is counted exactly once; max_files bounds what is in flight.
    """

    def one(df: DataFrame, number: int) -> None:
        store.run_batch(adapter(df), f"{number:06d}")

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    stream = (source.json if fmt == "json" else source.parquet)(folder)
    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")).start()
