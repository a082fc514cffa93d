"""Progress, leases and time-to-live over timestamps, with an explicit now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import Text, col


def seconds(later: Text, earlier: Text) -> Column:
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later)) / F.lit(1_000_000.0)


def progress(df: DataFrame, started: str, now: str, done: str, total: str) -> DataFrame:
    """Adds elapsed and remaining seconds and units a second; what is left is known only for a running, moving job of known size."""
    elapsed = F.greatest(F.lit(0.0), seconds(now, started))
    speed = F.when(elapsed > 0, F.col(done) / elapsed).otherwise(0.0)
    running = F.col(total).isNotNull() & (F.col(done) < F.col(total)) & (speed > 0)
    return df.withColumns({"elapsed": elapsed, "speed": speed, "remaining": F.when(running, (F.col(total) - F.col(done)) / F.nullif(speed, F.lit(0.0)))})


def claimable(tasks: DataFrame, now: Column, status: str = "status", lease: str = "lease_until") -> DataFrame:
    """Tasks that are pending, or running with a lease that has ended."""
    return tasks.where((F.col(status) == "pending") | ((F.col(status) == "running") & (F.coalesce(F.col(lease), F.lit("1970-01-01").cast("timestamp_ntz")) <= now)))


def alive(entries: DataFrame, now: Column, created: str, ttl_seconds: Column, expires: str | None = None) -> DataFrame:
    """Entries whose own expiry, or creation and time to live, isn't reached."""
    by_ttl = F.timestamp_add("SECOND", ttl_seconds, F.col(created))
    end = F.coalesce(F.col(expires), by_ttl) if expires else by_ttl
    return entries.withColumn("expires", end).where(F.col("expires") > now)
