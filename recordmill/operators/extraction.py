"""The base projection: a wrapper's text to one wide record, each part by one pass of its parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import commands, documents, markup, paths, text

# Spellings of the two artifact forms.
FORMS = {"xml": "xml", "tool_xml": "xml", "wrapper": "xml", "yaml": "yaml", "yml": "yaml", "udt": "yaml", "udt_yaml": "yaml"}


def form(name: Column | str) -> Column:
    """The artifact form that a name stands for; other names raise an error when met."""
    low = F.lower(text.stripped(name))
    known = F.coalesce(*[F.when(low == k, v) for k, v in FORMS.items()])
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown artifact form: "), low)).cast("string"))


def records(wrappers: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tool_id, tool_name, version, help, command, programs, packages, versions, containers, datatypes, inputs, outputs, tests, score, well_formed)."""
    parsed = wrappers.select(F.col(id_col).alias("id"), text.filled(text_col).alias("body"), markup.xml_features(F.col(text_col)).alias("f"), markup.parts(F.col(text_col)).alias("p"), markup.structural_report(F.col(text_col)).alias("r"))
    root = F.regexp_extract("body", r"(?is)<tool\b([^>]*)>", 1)
    attribute = lambda name: F.regexp_extract(root, rf"\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)
    return parsed.withColumn("called", commands.called(F.col("f.command"))).select(
        "id", attribute("id").alias("tool_id"), attribute("name").alias("tool_name"), attribute("version").alias("version"), F.coalesce("p.help", F.lit("")).alias("help"), F.coalesce("f.command", F.lit("")).alias("command"),
        F.array_distinct(F.transform("called", lambda c: c["program"])).alias("programs"), F.coalesce("p.packages", F.array().cast("array<string>")).alias("packages"), "p.versions", F.coalesce("p.containers", F.array().cast("array<string>")).alias("containers"),
        F.coalesce("f.datatypes", F.array().cast("array<string>")).alias("datatypes"), "r.inputs", "r.outputs", "r.tests", "r.score", "f.well_formed",
    )


def side_files(files: DataFrame, most_bytes: int) -> DataFrame:
    """(path, role, kind, chars, kept_bytes, hash, calls, docs, skip) of files beside wrappers, given as (path, folder, content).

    Contents are cut at ``most_bytes`` without cutting a character; skipped files keep their reason only.
    """
    from .texts import truncate_bytes

    skip = paths.skip_reason("path", "folder", F.octet_length("content"), most_bytes * 10)
    kept = files.withColumn("skip", skip).withColumn("kept", F.when(F.col("skip") == "", truncate_bytes(F.col("content"), most_bytes)))
    python = paths.ending("path") == "py"
    return kept.select(
        "path", paths.sidecar_role("path", F.lit("")).alias("role"), paths.config_kind("path", "content").alias("kind"), F.length("content").alias("chars"), F.octet_length("kept").alias("kept_bytes"), F.sha2("content", 256).alias("hash"),
        F.when(python, F.transform(documents.calls("kept"), lambda c: c["call"])).otherwise(documents.r_calls("kept")).alias("calls"), F.size(documents.parameter_docs("kept")).alias("docs"), "skip",
    )


def failure_of(found: Column, well_formed: Column, root_is_tool: Column, unknown: Column) -> Column:
    """struct(error, cut): why a generated document fails, first reason first, and whether it was cut off; no error if it passes."""
    cut = F.exists(found["problems"], lambda p: p.isin("no_end_tag", "cut_in_tag", "open_cdata"))
    error = (
        F.when(~F.coalesce(well_formed, F.lit(False)) & cut, "the document is cut off")
        .when(~F.coalesce(well_formed, F.lit(False)), "the document can't be parsed")
        .when(~F.coalesce(root_is_tool, F.lit(False)), "the document is no tool")
        .when(F.size(found["problems"]) > 0, F.concat(F.lit("degenerate: "), F.array_join(found["problems"], ", ")))
        .when(unknown > 0, "unknown datatypes")
    )
    return F.struct(error.alias("error"), cut.alias("cut"))
