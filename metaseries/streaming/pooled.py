"""Pooled estimates of a stream, by tumbling windows. Goes beyond the batch series."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaseries.sources.tables import working_folder


def windowed_means(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Count, mean and standard error of each event type's values in each window.

    Works on a streaming or a batch table with ``ts, event_type, value``; rows later
    than ``late`` behind the newest are dropped from a stream's windows.
    """
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").withWatermark("ts", late)
    n = F.count("value")
    return (
        timed.groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(n.alias("n"), F.avg("value").alias("mean"), F.sqrt(F.var_samp("value") / n).alias("se"))
        .select(F.col("w.start").alias("start"), "event_type", "n", "mean", "se")
    )


def run_available(spark: SparkSession, folder: str, name: str = "events.parquet", checkpoint: str | None = None) -> DataFrame:
    """Run the stream over what ``folder`` holds now, and return the last state of each window.

    Windows that changed are written by each micro-batch, in a folder of its own that a
    repeated batch overwrites, and the latest of a window counts; so windows behind the
    watermark leave the stream's state, which stays bounded. Results and checkpoint are
    in the working folder, so a restart takes up where the stream stopped.
    """
    base = checkpoint or f"{working_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{folder}/{name}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/result/batch={number}")

    running = windowed_means(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    last = F.max(F.struct("batch", "n", "mean", "se")).alias("last")
    return spark.read.parquet(f"{base}/result").groupBy("start", "event_type").agg(last).select("start", "event_type", "last.n", "last.mean", "last.se")
