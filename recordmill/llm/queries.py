"""The queries of this subpackage; each runs over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunking, data, encoding, garbled, leaks, residue, split_groups, split_overlap
from .near_duplicates import NearDuplicates


def _help_duplicates(spark: SparkSession, d: str) -> NearDuplicates:
    return NearDuplicates(data.help_records(spark, d), "pos", "text", threshold=0.6, shingle=3)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _help_duplicates(spark, d).pairs().select(F.col("a").alias("pos_a"), F.col("b").alias("pos_b"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return _help_duplicates(spark, d).groups().withColumnRenamed("id", "pos")


HELP_FIELDS = ("help_text", "container_help_text", "container_usage_text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    records = data.table(spark, d, "tool_records").select("pos", *HELP_FIELDS)
    return residue.residue(records, "pos", HELP_FIELDS).withColumnRenamed("id", "pos")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    """The records without residue, by their keys."""
    records = data.table(spark, d, "tool_records").select("pos", "package_id", "tool_id", *HELP_FIELDS)
    return residue.clean(records, "pos", HELP_FIELDS).select("pos", "package_id", "tool_id")


def p2_validation(spark: SparkSession, d: str) -> DataFrame:
    records = data.table(spark, d, "tool_records").select("pos", "shed_owner", *HELP_FIELDS)
    return residue.validation(records, "pos", HELP_FIELDS, "shed_owner")


def _sides(spark: SparkSession, d: str) -> DataFrame:
    """(pos, split, source, train) of the records that are in a split, once each."""
    members = data.table(spark, d, "split_members").select("pos", F.lower(data.trimmed("split")).alias("split"), "source")
    return members.where(F.col("split").isin("train", "validation", "test") & F.col("pos").isNotNull()).distinct().withColumn("train", F.col("split") == "train")


def _across(spark: SparkSession, d: str) -> DataFrame:
    """(train, eval) of the records that are the same or nearly the same on both sides."""
    records = data.table(spark, d, "tool_records").select("pos", "help_text", "tool_id", "wrapper_path")
    sides = _sides(spark, d).select("pos", "train").distinct()
    texts = records.where(data.word_count("help_text") >= 40).select(F.col("pos").alias("id"), F.col("help_text").alias("text"))
    alike = split_overlap.near_pairs(texts, threshold=0.6, shingle=3, sides=sides.withColumnRenamed("pos", "id")).select("train", "eval")
    tool = F.regexp_replace(F.lower(data.trimmed("tool_id")), "[-_ ]", "_")
    wrapper = data.path_form("wrapper_path")
    keyed = records.select("pos", F.when(data.trimmed("tool_id") != "", tool).alias("tool"), F.when(wrapper != "", wrapper).alias("wrapper"))
    same = split_overlap.same_keys(keyed.where("tool IS NOT NULL AND wrapper IS NOT NULL").join(sides, "pos").withColumnRenamed("pos", "id"), "tool", "wrapper")
    return alike.union(same).distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _across(spark, d).select(F.least("train", "eval").alias("pos_a"), F.greatest("train", "eval").alias("pos_b")).distinct()


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs, and records with at least one, of each evaluation split and source."""
    sides = _sides(spark, d).where("NOT train").select(F.col("pos").alias("eval"), "split", "source")
    return _across(spark, d).join(sides, "eval").groupBy("split", "source").agg(F.count("*").alias("pairs"), F.countDistinct("eval").alias("records"))


def _oversized(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of all values of the two help columns that are over the limit."""
    fields = ("help_text", "container_help_text")
    rows = data.table(spark, d, "tool_records").select("pos", *fields)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]))
    values = rows.where(" OR ".join(f"octet_length({f}) > {chunking.LIMIT}" for f in fields)).select("pos", each.alias("v")).select(F.concat_ws(":", "pos", "v.field").alias("item"), "v.text")
    pieces = chunking.split_texts(values, "item", "text")
    return pieces.select(F.split_part("item", F.lit(":"), F.lit(1)).cast("long").alias("pos"), F.split_part("item", F.lit(":"), F.lit(2)).alias("field"), "piece_no", "begin", "stop", "piece")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _oversized(spark, d).where("piece_no = 0").select("pos", "field")


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _oversized(spark, d)


def _relations() -> dict:
    return {"suite": data.key("suite_id"), "package": data.key("package_id"), "dir": data.path_key("tool_dir")}


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    records = data.table(spark, d, "tool_records").select("pos", "suite_id", "package_id", "tool_dir")
    return split_groups.related(records, "pos", _relations(), "package").withColumnRenamed("id", "pos")


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    records = data.table(spark, d, "tool_records").select("pos", "suite_id", "package_id", "tool_dir")
    return split_groups.assign(records, "pos", _relations()).withColumnRenamed("id", "pos")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode(data.table(spark, d, "documents"), "doc_id", "text")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(data.table(spark, d, "documents"), data.table(spark, d, "heldout_items"), "doc_id", "item_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Documents and longest leak of each leaked item."""
    return _leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("longest"))


def p7_near(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold all words of twelve consecutive ones of an item among fifteen, in any order."""
    found = leaks.leaks(data.table(spark, d, "documents"), data.table(spark, d, "heldout_items"), "doc_id", "item_id", slop=3)
    return found.select("doc_id", "item_id", F.col("spans").alias("places"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled.restore(data.table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    return garbled.restore(data.table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_clean, p2_validation, p3_found, p3_counts, p4_found, p4_pieces, p5_found, p5_splits, p6_ids, p7_found, p7_items, p7_near, p8_found, p8_restored)}
#: Equivalent SQL where SQL over whole tables is quick enough.
ORACLES: dict[str, str] = {
    "p4_found": """
        SELECT pos, 'help_text' AS field FROM tool_records WHERE strlen(help_text) > 6000
        UNION ALL SELECT pos, 'container_help_text' FROM tool_records WHERE strlen(container_help_text) > 6000""",
}
