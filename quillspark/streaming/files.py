"""The batch functions on streams: folders of files, urls seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.operators.steps import cleaned


def text_stream(spark: SparkSession, path: str, files_at_once: int = 10) -> DataFrame:
    """path, text of files as they arrive, so many a batch at most."""
    read = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_at_once)
    return read.load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def cleaned_stream(texts: DataFrame) -> DataFrame:
    return cleaned(texts, "text")


def new_urls(links: DataFrame, time: str | None = None, late: str = "1 hour") -> DataFrame:
    """Each url once; with a time column, remembered as long as the watermark allows."""
    return links.withWatermark(time, late).dropDuplicatesWithinWatermark(["url"]) if time else links.dropDuplicates(["url"])


def activity(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and their values by window and type."""
    windowed = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return windowed.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def updates_to_end(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Run an aggregation over what is there and stop; each batch writes the rows it changed to a folder of its own.

    State is kept as long as the watermark asks for; ``latest_of`` reads the result.
    A batch that is run again replaces its folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latest_of(updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The last update of each key."""
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*keys, *(F.col(f"last.{v}").alias(v) for v in values))


def new_keys_to_end(stream: DataFrame, key: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Run over what is there and stop; keys never seen before are added to the table, which is the memory.

    The memory lasts over runs and is on storage, not in a state that grows; to
    forget, begin with another table and checkpoint.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = spark.read.schema(f"{key} string, batch long").parquet(table_path) if number else spark.createDataFrame([], f"{key} string, batch long")
        fresh = batch.where(F.col(key).isNotNull()).distinct().join(known.where(F.col("batch") != number).select(key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stop(query: StreamingQuery) -> None:
    """Stop a running stream; what its checkpoint holds is gone on with by the next run."""
    query.stop()
    query.awaitTermination(60)


def run_to_end(stream: DataFrame, table_path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run over what is there and stop; results as Parquet."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(table_path)
    query.awaitTermination()
    return query
