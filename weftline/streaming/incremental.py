"""Incremental mirrors and event windows over Structured Streaming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.core import materialize, remove
from weftline.operators.merge import upsert


def last_changes(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last change of each key."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return changes.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def mirror(spark: SparkSession, source: DataFrame, target: str, checkpoint: str, key: str, order: list[str], deleted: str, buckets: int = 64):
    """Replay a stream of changes into a Parquet table; an archive already seen is skipped.

    Rows lie in buckets by a hash of their key, and a batch rewrites only the buckets that it changes. Each is made from
    what it holds and the last change of each key, so a batch that is run again leaves the same rows. Batches also write
    how they left a bucket before that replaces it, as a table cannot be read and replaced at once.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")

    def apply(batch: DataFrame, number: int) -> None:
        new = last_changes(batch, key, order).select("*", bucket)
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most the number of buckets
        if not touched:
            return
        rows = new.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
        try:
            current = spark.read.schema(rows.schema).parquet(target).where(F.col("bucket").isin(touched))
            rows = upsert(current, new, [key], deleted)
        except AnalysisException:
            pass  # the table is not there yet
        whole = materialize(spark, rows, "mirror")
        left = {r["bucket"] for r in whole.select("bucket").distinct().collect()}
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)
        for k in set(touched) - left:  # every row of it was taken away
            remove(spark, f"{target.rstrip('/')}/bucket={k}")

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _late(events: DataFrame, time: str, late: str) -> DataFrame:
    return events.withWatermark(time, late) if events.isStreaming else events


def tumbling(events: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts by window; works on streams (with a watermark, so that windows end and their state goes) and on tables."""
    return _late(events, time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sliding(events: DataFrame, time: str, width: str, step: str, *keys: str, late: str = "1 hour") -> DataFrame:
    return _late(events, time, late).groupBy(F.window(time, width, step).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, time: str, gap: str, *keys: str, late: str = "1 hour") -> DataFrame:
    return _late(events, time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
