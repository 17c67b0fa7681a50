"""Job and fleet figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellframe.functions.scalars import days_hours_minutes, runtime_minutes


def job_stats(jobs: DataFrame, compat: bool = False) -> DataFrame:
    """Per host: running jobs, finished jobs, mean minutes of the finished ones (null if none)."""
    state = F.col("state")
    minutes = F.when(state == "finished", runtime_minutes("end_time", "start_time", compat))
    return jobs.groupBy("host").agg(
        F.count_if(state == "running").alias("running"),
        F.count_if(state == "finished").alias("finished"),
        F.avg(minutes).alias("avg_minutes"),
    )


def fleet_summary(hosts: DataFrame, now: Column) -> DataFrame:
    """``hosts(host, alive, spawned, started_at)`` -> live hosts, batches spawned, time since the first start."""
    totals = hosts.agg(
        F.count_if("alive").alias("alive_hosts"),
        F.coalesce(F.sum("spawned"), F.lit(0)).alias("spawned"),
        F.min("started_at").alias("_since"),
    )
    return totals.withColumn("elapsed", days_hours_minutes(now, "_since")).select(
        "alive_hosts", "spawned", "elapsed.*"
    )
