"""Session helpers: a session for tests and tools, and the shared folder for written stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "4g") -> SparkSession:
    """A local session with the settings that the library is tested with."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordmill")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written stages.

    A cluster names a folder that all executors share in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    made = "file://" + tempfile.mkdtemp(prefix="recordmill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan in as many partitions as there are cores, if its files make fewer: a small file would keep one core busy."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
