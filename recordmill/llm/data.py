"""Reading of the tables and the key forms that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import JAVA_WORD

#: Words that stand for a missing key.
STAND_INS = ["", "-", "--", ".", "?", "??", "n/a", "na", "n.a.", "nan", "nil", "no", "none", "not available", "null", "tba", "tbd", "todo", "undefined", "unknown", "unspecified", "xxx"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(c: Column | str) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(c, r"(?U)^[\s\x{0}]+|[\s\x{0}]+$", "")


def key(c: Column | str) -> Column:
    """Trimmed and lower-cased; null for blank values and stand-ins."""
    k = F.lower(trimmed(c))
    return F.when(~k.isin(STAND_INS), k)


def path_form(c: Column | str) -> Column:
    """A path without case, direction and doubling of separators, a leading ``./`` and outer separators."""
    p = F.regexp_replace(F.lower(trimmed(c)), r"[\\/]+", "/")
    return F.regexp_replace(F.regexp_replace(p, r"^(\./)+", ""), "^/|/$", "")


def path_key(c: Column | str) -> Column:
    """``path_form``; null for blank values, stand-ins and the bare path ``.``."""
    p = path_form(c)
    return F.when(~p.isin(STAND_INS), p)


def word_count(c: Column | str) -> Column:
    return F.coalesce(F.regexp_count(F.lower(c), F.lit(JAVA_WORD)), F.lit(0))


def help_records(spark: SparkSession, sf_dir: str, min_words: int = 40) -> DataFrame:
    """(pos, text) of the records whose help_text has at least ``min_words`` words; text is description, one blank, help."""
    rows = table(spark, sf_dir, "tool_records").select("pos", "help_text", "shed_description")
    text = F.concat(F.coalesce("shed_description", F.lit("")), F.lit(" "), F.coalesce("help_text", F.lit("")))
    return rows.where(word_count("help_text") >= min_words).select("pos", text.alias("text"))
