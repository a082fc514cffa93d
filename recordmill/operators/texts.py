"""Operators over the lines of texts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def _numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, line) with trimmed lines."""
    return df.select(id_col, F.posexplode(text.lines(text_col)).alias("k", "raw")).select(id_col, "k", text.stripped("raw").alias("line"))


def collapsed(df: DataFrame, id_col: str, text_col: str, copies: int = 2) -> DataFrame:
    """(id, kept, omitted) if each line may occur ``copies`` times; blank lines always stay.

    Counted inside each text, without an exchange of lines: a text's distinct lines are few.
    """
    trimmed = F.array_sort(F.transform(text.lines(text_col), lambda x: text.stripped(x)))
    # In sorted order a line too many equals the one so many places before.
    again = lambda s: F.zip_with(s, F.slice(s, copies + 1, F.size(s)), lambda a, b: (a == b) & (a != ""))
    over = text.let(trimmed, lambda s: F.size(F.filter(again(s), lambda x: x)))
    return df.select(id_col, F.size(text.lines(text_col)).cast("long").alias("n"), over.cast("long").alias("omitted")).select(id_col, (F.col("n") - F.col("omitted")).alias("kept"), "omitted")


def repeated_lines(df: DataFrame, id_col: str, text_col: str, min_chars: int, min_times: int) -> DataFrame:
    """(id, line, times)."""
    return _numbered(df, id_col, text_col).where(F.length("line") >= min_chars).groupBy(id_col, "line").agg(F.count("*").alias("times")).where(F.col("times") >= min_times)


def line_kind(line: Column | str) -> Column:
    low = F.lower(text.col(line))
    return (
        F.when(text.col(line) == "", None)
        .when(low.rlike(r"^(usage|synopsis)([^a-z0-9_]|$)"), "usage")
        .when(text.col(line).rlike(r"^--?[A-Za-z0-9]"), "option")
        .when(low.rlike(r"(^|[^a-z0-9_])inputs?([^a-z0-9_]|$)"), "input")
        .when(low.rlike(r"(^|[^a-z0-9_])(outputs?|results?|writes?)([^a-z0-9_]|$)"), "output")
    )


def interface_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, line, kind) of the lines that tell how a program is called."""
    return _numbered(df, id_col, text_col).withColumn("kind", line_kind("line")).where("kind IS NOT NULL")


def terms(df: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """(id, terms): the vocabulary's words that the text has as whole words, in the vocabulary's order."""
    low = F.lower(text.filled(text_col))
    hits = F.filter(F.array(*[F.when(low.rlike(rf"(^|[^a-z0-9_]){re.escape(t)}([^a-z0-9_]|$)"), t) for t in vocabulary]), lambda x: x.isNotNull())
    return df.select(id_col, F.array_join(hits, ",").alias("terms"))


def truncate_bytes(x: Column, limit: int, marker: str = "") -> Column:
    """The longest beginning of at most ``limit`` UTF-8 bytes that cuts no character, and a marker."""
    room = limit - len(marker.encode())

    @F.pandas_udf("string")
    def cut(values: pd.Series) -> pd.Series:
        return values.map(lambda t: t if t is None or len(t.encode()) <= limit else t.encode()[:room].decode("utf-8", "ignore") + marker)

    return cut(x)


_KEY_LINE = re.compile(r"(?i)^\s*(?:usage|synopsis|options?|arguments?|inputs?|outputs?|--?[a-z0-9])")


def shape(value: str, budget: int) -> tuple[str, int]:
    """(text within the budget, characters left out): the beginning, then key lines, then the others, in order."""
    lines = [line.rstrip() for line in re.split(r"\r\n?|\n", value)]
    if len("\n".join(lines)) <= budget:
        return "\n".join(lines), 0
    head = min(3000, max(600, budget // 3)) if budget >= 600 else budget // 3
    chosen: set[int] = set()
    used = 0

    def take(numbers: list[int], room: int) -> None:
        nonlocal used
        for k in numbers:
            if k in chosen:
                continue
            if used + len(lines[k]) + 1 > room:
                break
            chosen.add(k)
            used += len(lines[k]) + 1

    take(list(range(len(lines))), min(head, budget))
    take([k for k, line in enumerate(lines) if _KEY_LINE.match(line)], budget)
    take(list(range(len(lines))), budget)
    kept = "\n".join(lines[k] for k in sorted(chosen))
    return kept, len(value) - len(kept)


def shaped(df: DataFrame, id_col: str, text_col: str, budget: int) -> DataFrame:
    """(id, shaped, left_out)."""

    @F.pandas_udf("shaped string, left_out long")
    def one(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shape(v or "", budget) for v in values], columns=["shaped", "left_out"])

    return df.select(id_col, one(F.col(text_col)).alias("s")).select(id_col, "s.shaped", "s.left_out")
