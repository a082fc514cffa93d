"""JSON lines with the three policies for lines that can't be read, and the stores built on them.

``drop`` leaves such lines out, ``count`` keeps them as rows with ``_corrupt``, ``fail`` stops. Lines end at
LF only. ``pos`` is the order key: file by file, line by line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank, stripped

CORRUPT = "_corrupt"


def read(spark: SparkSession, path: str, schema: T.StructType | str, policy: str = "drop") -> DataFrame:
    """Rows of ``schema``, and ``pos``; missing fields are null, others are left out, blank lines are skipped."""
    modes = {"drop": "DROPMALFORMED", "count": "PERMISSIVE", "fail": "FAILFAST"}
    if policy not in modes:
        raise ValueError(f"unknown policy {policy!r}")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if policy == "count":
        # Parsed as an expression: the reader itself can't count corrupt lines alone.
        kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        lines = spark.read.option("lineSep", "\n").text(path).where(~blank("value"))
        parsed = lines.select(F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
        return parsed.select("r.*").withColumn("pos", F.monotonically_increasing_id())
    reader = spark.read.option("lineSep", "\n").option("mode", modes[policy])
    return reader.schema(schema).json(path).withColumn("pos", F.monotonically_increasing_id())


def with_defaults(df: DataFrame) -> DataFrame:
    """Empty text, false, zero and empty array for missing fields."""
    out = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in (CORRUPT, "pos"):
            continue
        if isinstance(f.dataType, T.StringType):
            out[f.name] = F.coalesce(c, F.lit(""))
        elif isinstance(f.dataType, T.BooleanType):
            out[f.name] = F.coalesce(c, F.lit(False))
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.ArrayType):
            out[f.name] = F.coalesce(c, F.array().cast(f.dataType))
    return df.withColumns(out)


def integrity(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines, those that aren't JSON objects, and whether there are none of these."""
    lines = spark.read.option("lineSep", "\n").text(path).where(~blank("value"))
    good = F.coalesce(F.json_object_keys("value").isNotNull(), F.lit(False)) & stripped("value").startswith("{")
    return lines.agg(F.count("*").alias("lines"), F.count_if(~good).alias("invalid")).withColumn("valid", F.col("invalid") == 0)


def checkpoint_keys(spark: SparkSession, path: str) -> DataFrame:
    """(key): the distinct lines of a checkpoint that aren't blank."""
    return spark.read.text(path).select(stripped("value").alias("key")).where("key <> ''").distinct()


def manifest_paths(spark: SparkSession, path: str) -> DataFrame:
    """(wrapper_path) of a retry manifest ``{"wrappers": [{"wrapper_path": ...}]}``."""
    doc = spark.read.schema("wrappers array<struct<wrapper_path:string>>").option("multiLine", True).json(path)
    return doc.select(F.explode("wrappers").alias("w")).select("w.wrapper_path").where("wrapper_path <> ''").distinct()


def keyed_store(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value) of a document ``{"entries": {key: value}}``; ``value`` is the entries' type."""
    doc = spark.read.schema(f"entries map<string,{value}>").option("multiLine", True).json(path)
    return doc.select(F.explode("entries").alias("key", "value"))


def last_of_key(df: DataFrame, key: str) -> DataFrame:
    """The last row of each key by ``pos``."""
    from ..operators.relational import last_wins

    return last_wins(df, [key], "pos")


def write(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; characters beyond ASCII stay as they are, nulls are left out."""
    df.write.mode(mode).json(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str, key: str):  # noqa: ANN201
    """Append a stream's records once for each key and batch: a batch that is tried again replaces its own folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").json(f"{path}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document; a row of nulls where it is missing or broken."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([()], T.StructType([])).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(schema).fields])
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.from_json("value", schema).alias("d")).select("d.*")


def records_of(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of a document that is a list of them or holds it under ``records``; what isn't an object is left out."""
    whole = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"array<struct<{schema}>>")
    held = F.from_json("value", f"records array<struct<{schema}>>")["records"]
    each = F.when(F.ltrim("value").startswith("["), listed).otherwise(held)
    return whole.select(F.posexplode(each).alias("place", "r")).where("r IS NOT NULL").select("place", "r.*")


def last_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """(pos, value) of the last ``n`` lines, in order."""
    rows = spark.read.option("lineSep", "\n").text(path).withColumn("pos", F.monotonically_increasing_id())
    return rows.orderBy(F.desc("pos")).limit(n).select("pos", "value").orderBy("pos")


def last_valid(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last line of a log that is a JSON object, as one row; none if there is none."""
    rows = spark.read.option("lineSep", "\n").text(path).withColumn("pos", F.monotonically_increasing_id())
    good = rows.where(F.coalesce(F.json_object_keys("value").isNotNull(), F.lit(False)))
    return good.agg(F.max_by("value", "pos").alias("v")).where("v IS NOT NULL").select(F.from_json("v", schema).alias("d")).select("d.*")
