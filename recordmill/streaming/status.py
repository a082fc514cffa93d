"""Status logs as streams: latest event, windows, first of a key, leases with state; and the same over tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_dir


def read_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A file stream with the schema of what lies at ``path``."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():  # a stream watches folders
        return stream.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())
    return stream.parquet(path)


def run_to_end(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a stream over all there is and return its result as a table.

    Each micro-batch is written to a folder of its own number, so a batch that is tried again replaces
    what it left; in ``complete`` mode the last batch is the result, else their union.
    """
    spark = stream.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    last: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")
        last.append(number)

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    schema = stream.schema
    if not last:
        return spark.createDataFrame([], schema)
    if mode == "complete":
        return spark.read.schema(schema).parquet(f"{base}/out/batch={max(last)}")
    return spark.read.schema(schema).parquet(*[f"{base}/out/batch={n}" for n in sorted(set(last))])


def latest(df: DataFrame, key: str, time: str, tie: str, columns: list[str]) -> DataFrame:
    """The last event of each key by time, ties by ``tie``; the same for tables and streams."""
    row = F.max_by(F.struct(*columns, tie), F.struct(time, tie))
    return df.groupBy(key).agg(row.alias("last")).select(key, "last.*")


def latest_by_stream(spark: SparkSession, path: str, key: str, time: str, tie: str, columns: list[str]) -> DataFrame:
    return run_to_end(latest(read_files(spark, path), key, time, tie, columns), "complete", "latest")


def windowed_by_stream(spark: SparkSession, path: str, time: str, key: str, width: str) -> DataFrame:
    """(began, key, n) of tumbling windows; events later than a week behind the newest would be left out."""
    events = read_files(spark, path).withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", "7 days")
    counts = events.groupBy(F.window("_t", width), key).agg(F.count("*").alias("n"))
    return run_to_end(counts, "complete", "windows").select(F.col("window.start").cast("timestamp_ntz").alias("began"), key, "n")


def first_of_key(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Events whose key wasn't met within the delay before."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


LEASES = "task string, worker string, action string, at timestamp"
DECISIONS = "task string, worker string, at timestamp, outcome string, lease_until timestamp"


def leases(requests: DataFrame, lease_seconds: int) -> DataFrame:
    """Decide claims, heartbeats and completions of tasks, keyed by task, so that a claim is atomic.

    A claim succeeds on a task that is free or whose lease has ended; a heartbeat by the holder prolongs it;
    after a completion nothing succeeds. Requests of one micro-batch are taken in order of time.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        holder, until, done = state.get if state.exists else ("", 0, False)
        rows = []
        for r in pd.concat(list(frames)).sort_values(["at", "worker", "action"]).itertuples():
            now = int(r.at.timestamp())
            if done:
                outcome = "task_done"
            elif r.action == "claim":
                outcome = "claimed" if not holder or until <= now else "held"
                if outcome == "claimed":
                    holder, until = r.worker, now + lease_seconds
            elif holder != r.worker:
                outcome = "worker_mismatch"
            elif r.action == "heartbeat":
                outcome, until = "prolonged", now + lease_seconds
            else:
                outcome, done = "completed", True
            rows.append((key[0], r.worker, r.at, outcome, pd.Timestamp(until, unit="s")))
        state.update((holder, until, done))
        yield pd.DataFrame(rows, columns=["task", "worker", "at", "outcome", "lease_until"])

    return requests.groupBy("task").applyInPandasWithState(step, DECISIONS, "holder string, until long, done boolean", "append", "NoTimeout")


def sessions(df: DataFrame, key: str, time: str, tie: str, gap_seconds: int) -> DataFrame:
    """(key, session, events, began, ended): an event that follows within the gap belongs to the same session."""
    order = Window.partitionBy(key).orderBy(time, tie)
    apart = F.timestamp_diff("MICROSECOND", F.lag(time).over(order), F.col(time))
    marked = df.withColumn("_fresh", F.when(apart < gap_seconds * 1_000_000, 0).otherwise(1))
    numbered = marked.withColumn("session", F.sum("_fresh").over(order))
    return numbered.groupBy(key, "session").agg(F.count("*").alias("events"), F.min(time).alias("began"), F.max(time).alias("ended"))


TIMEOUTS = "record string, started timestamp, outcome string"


def record_timeouts(events: DataFrame, seconds: int, delay: str = "0 seconds") -> DataFrame:
    """TIMEOUTS of (record, status, at): each record's end, or ``timeout`` once the watermark passes its limit.

    ``status`` is ``started`` or anything else, which ends the record. A record that starts again begins anew.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        rows = []
        if state.hasTimedOut:
            rows.append((key[0], pd.Timestamp(state.get[0], unit="s"), "timeout"))
            state.remove()
        else:
            started = state.get[0] if state.exists else None
            for r in pd.concat(list(frames)).sort_values("at").itertuples():
                if r.status == "started":
                    started = int(r.at.timestamp())
                elif started is not None:
                    late = r.at.timestamp() > started + seconds
                    rows.append((key[0], pd.Timestamp(started, unit="s"), "timeout" if late else r.status))
                    started = None
            if started is None:
                if state.exists:
                    state.remove()
            else:
                state.update((started,))
                if (started + seconds) * 1000 > state.getCurrentWatermarkMs():
                    state.setTimeoutTimestamp((started + seconds) * 1000)
                else:
                    rows.append((key[0], pd.Timestamp(started, unit="s"), "timeout"))
                    state.remove()
        yield pd.DataFrame(rows, columns=["record", "started", "outcome"])

    watched = events.withWatermark("at", delay)
    return watched.groupBy("record").applyInPandasWithState(step, TIMEOUTS, "started long", "append", "EventTimeTimeout")
