"""Restartable ingest of new files: each file once by the checkpoint, each key once by the state of the query.

Keys that were seen lie in a RocksDB state store in the checkpoint, dealt over its partitions by hash, so a batch looks up its own keys and
never reads the target. A batch writes its rows to a folder of its own number in the target, over what an attempt before may have left
there; so a batch that was killed at any point is run again with the same result. The target has the number in its column ``batch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellum.functions import scalars as S

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _once(rows: DataFrame, key: str, checkpoint: str, target: str) -> StreamingQuery:
    """Starts a query that adds the first row of each new key and ends when it has read what there is now."""
    spark = rows.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)  # a query keeps the settings that it was started with
    try:
        return rows.dropDuplicates([key]).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STORE[0], before) if before else spark.conf.unset(STORE[0])


def ingest_available(spark: SparkSession, folder: str, checkpoint: str, target: str, prefix: str = "files", glob: str = "*.txt") -> StreamingQuery:
    """Starts a query that reads the files there are now as (source_key, file_name, full_text, batch) and ends. Of rows of one batch that share a key any one stays."""
    rows = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob).load(folder)
    name = S.base_name(S.decoded(F.col("_metadata.file_path")))
    texts = rows.select(name.alias("file_name"), S.strip("value").alias("full_text"))
    return _once(texts.select(S.source_key("file_name", prefix).alias("source_key"), "file_name", "full_text"), "source_key", checkpoint, target)


def ingest_json(spark: SparkSession, folder: str, checkpoint: str, target: str, schema: str, key: str) -> StreamingQuery:
    """The same for JSON records keyed by a column; records without a key count as one key."""
    return _once(spark.readStream.schema(schema).json(folder), key, checkpoint, target)
