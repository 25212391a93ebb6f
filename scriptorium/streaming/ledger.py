"""The usage ledger as a stream: rollups by event time, and the latest status of jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def source(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def rollup(ledger: DataFrame, ts: str, model: str, cost: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Calls and cost by model and window; rows later than the watermark are dropped."""
    out = ledger.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), model)
    return out.agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum(cost), 4).alias("cost")).select(F.col("w.start").alias("window_start"), model, "calls", "cost")


def deduplicated(events: DataFrame, key: str, ts: str, late: str = "4 hours") -> DataFrame:
    """The first event of each key within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def latest(jobs: DataFrame, job: str, ts: str, status: str) -> DataFrame:
    """The last status of each job; of equal times the largest."""
    return jobs.groupBy(job).agg(F.max(F.struct(ts, status)).alias("__last")).select(job, F.col(f"__last.{status}").alias(status), F.col(f"__last.{ts}").alias(ts))


def attempts(ledger: DataFrame, call: str, model: str, failed: str) -> DataFrame:
    """By model: calls, those that were tried again, attempts, and calls whose last attempt failed (rows: call, attempt, model, failed)."""
    per = ledger.groupBy(call, model).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("attempt", failed)).alias("last"))
    return per.groupBy(model).agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("n") > 1).alias("retried"), F.sum("n").alias("attempts"), F.count_if(F.col(f"last.{failed}")).alias("lost"))


def running(ledger: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """By group: the most calls that ran at once, and the least gap between two starts; calls that end as others start do not overlap."""
    steps = ledger.select(group, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")))).alias("x")).select(group, "x.*")
    per = steps.groupBy(group, "at").agg(F.sum(F.when(F.col("step") > 0, 1).otherwise(0)).alias("begun"), F.sum("step").alias("step"))
    w = Window.partitionBy(group).orderBy("at")
    level = per.withColumn("level", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    starts = ledger.select(group, F.col(start).alias("at")).withColumn("gap", F.col("at") - F.lag("at").over(w))
    return level.groupBy(group).agg(F.max("level").alias("at_once")).join(starts.groupBy(group).agg(F.min("gap").alias("least_gap")), group)


def run_once(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended to parquet files."""
    query = df.writeStream.format("parquet").option("path", path).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
