"""Writing of reports, snapshots and keyed stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank, filled

#: Rows of a report that is rendered as text; a report has one row a category, not a record.
REPORT_ROWS = 10_000


def document(df: DataFrame, path: str) -> None:
    """A small report as JSON lines, replacing what was there; the commit protocol makes it all or nothing."""
    df.coalesce(1).write.mode("overwrite").json(path)


def markdown(df: DataFrame, title: str) -> str:
    """A report of few rows as a Markdown table; more than REPORT_ROWS rows are an error."""
    rows = df.limit(REPORT_ROWS + 1).collect()
    if len(rows) > REPORT_ROWS:
        raise ValueError("a report of so many rows isn't read by anyone")
    cell = lambda v: str("" if v is None else v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(cell(v) for v in r) + " |" for r in rows), ""])


def snapshot(df: DataFrame, base: str, run_id: str) -> str:
    """The table of a completed run under ``runs/run_id``, and a pointer to the newest run; earlier runs stay."""
    place = f"{base.rstrip('/')}/runs/{run_id}"
    df.write.mode("overwrite").parquet(place)
    df.sparkSession.createDataFrame([(run_id, place)], "run_id string, path string").coalesce(1).write.mode("overwrite").json(f"{base.rstrip('/')}/current")
    return place


def current(spark: SparkSession, base: str) -> DataFrame:
    """The newest snapshot."""
    path = spark.read.schema("run_id string, path string").json(f"{base.rstrip('/')}/current").first()["path"]
    return spark.read.parquet(path)


def upsert(updates: DataFrame, base: str, key: str, order: str, version: int) -> None:
    """A keyed table as numbered versions: the new one has every key's row with the largest ``order``."""
    from ..operators.relational import last_wins

    rows = updates
    if version > 0:
        rows = updates.sparkSession.read.parquet(f"{base.rstrip('/')}/version={version - 1}").unionByName(updates)
    last_wins(rows, [key], order).write.mode("overwrite").parquet(f"{base.rstrip('/')}/version={version}")


def feedback(records: DataFrame, columns: list[str]) -> DataFrame:
    """Records in which any of the feedback columns isn't blank."""
    test = ~blank(columns[0])
    for c in columns[1:]:
        test = test | ~blank(c)
    return records.where(test)


def repeated_blocks(df: DataFrame, id_col: str, block_col: str) -> DataFrame:
    """(block hash, times, first): blocks that several documents have, word for word but for white space."""
    body = F.regexp_replace(filled(block_col), r"\s+", " ")
    keyed = df.where(~blank(block_col)).select(id_col, F.sha2(body, 256).alias("block"))
    return keyed.groupBy("block").agg(F.count("*").alias("times"), F.min(id_col).alias("first")).where("times > 1")
