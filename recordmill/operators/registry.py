"""Registries of runs, jobs and tasks: listing, upserts with merged maps, roll-ups, artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from .relational import first_n, job_state


def merged_map(old: Column | str, new: Column | str) -> Column:
    """Both maps' entries; the new one's where keys meet. Null maps are empty."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_zip_with(F.coalesce(old, empty), F.coalesce(new, empty), lambda k, a, b: F.coalesce(b, a))


def upserted(runs: DataFrame, updates: DataFrame, key: str, scalars: list[str], maps: list[str], time: str) -> DataFrame:
    """Runs with each one's updates applied: scalars are replaced where given, maps are merged, the time moves on."""
    u = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in (*scalars, *maps, time)])
    j = runs.join(u, key, "full_outer")
    return j.select(key, *[F.coalesce(f"_new_{c}", c).alias(c) for c in scalars], *[merged_map(c, f"_new_{c}").alias(c) for c in maps], F.greatest(F.col(time), F.col(f"_new_{time}")).alias(time))


def newest(runs: DataFrame, time: str, tie: str, kind: str | None = None, limit: int = 50) -> DataFrame:
    """The newest runs of a kind, or of all; none or fewer than one as limit gives all."""
    rows = runs.where(F.col("kind") == kind) if kind else runs
    ordered = rows.orderBy(F.desc(time), F.desc(tie))
    return ordered.limit(limit) if limit > 0 else ordered


def listing_counts(listed: DataFrame) -> DataFrame:
    """Counts by status and by kind of the rows listed, in one pass."""
    return listed.groupingSets([[F.col("status")], [F.col("kind")]], F.col("status"), F.col("kind")).agg(F.count("*").alias("n"))


def tasks_of(jobs: DataFrame, tasks: DataFrame) -> DataFrame:
    """(job_id, place, task_id, status) in the jobs' order; tasks that aren't there are left out."""
    return jobs.select("job_id", F.posexplode("task_ids").alias("place", "task_id")).join(tasks, "task_id").select("job_id", "place", "task_id", "status")


def jobs_state(jobs: DataFrame, tasks: DataFrame) -> DataFrame:
    """(job_id, state, done, total, share) of every job."""
    per = tasks_of(jobs, tasks).groupBy("job_id").agg(job_state("status").alias("state"), F.count_if(F.col("status") == "completed").alias("done"), F.count("*").alias("total"))
    return jobs.select("job_id").join(per, "job_id", "left").select("job_id", F.coalesce("state", F.lit("pending")).alias("state"), F.coalesce("done", F.lit(0)).alias("done"), F.coalesce("total", F.lit(0)).alias("total"), numbers.rate(F.coalesce("done", F.lit(0)), F.coalesce("total", F.lit(0))).alias("share"))


def artifacts(jobs: DataFrame, existing: DataFrame) -> DataFrame:
    """(job_id, artifact_id, path) of a job's files that exist; ids are a0, a1, ... by place."""
    listed = jobs.select("job_id", F.posexplode("artifacts").alias("place", "path"))
    return listed.join(existing.select("path").distinct(), "path", "left_semi").select("job_id", F.concat(F.lit("a"), "place").alias("artifact_id"), "path")


def packed_context(files: DataFrame, by: list[str], score: str, tie: str, chars: str, most_files: int, budget: int) -> DataFrame:
    """The best files of each group that fit a budget of characters; the last one in part: (by, place, kept)."""
    from pyspark.sql.window import Window

    ranked = first_n(files, by, [F.desc(score), F.asc(tie)], most_files)
    before = F.sum(chars).over(Window.partitionBy(*by).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(chars)
    return ranked.withColumn("_room", F.lit(budget) - before).where("_room > 0").withColumn("kept", F.least(F.col(chars), F.col("_room"))).drop("_room")
