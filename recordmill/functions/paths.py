"""Column expressions over file paths: exclusion, roles and relevance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Text, command_key, contains_any, filled

# Folders, endings and names that decide about source files.
VERSION_FOLDERS = [".git", ".hg", "__pycache__"]
EXCLUDED_FOLDERS = [".eggs", ".mypy_cache", ".nox", ".pytest_cache", ".tox", ".venv", "build", "dist", "node_modules", "site-packages", "target", "test", "test-data", "test_data", "tests"]
BUILD_FILES = ["setup.py", "setup.cfg", "pyproject.toml"]
MAIN_FILES = ["cli.py", "commands.py", "command.py", "__main__.py", "main.py", "main.c", "main.cc", "main.cpp"]
SOURCE_ENDINGS = ["py", "r", "pl", "sh", "bash", "rb", "js", "c", "cc", "cpp", "h", "java", "jl", "lua", "awk", "xml", "yml", "yaml", "txt", "md", "rst", "cfg", "toml", "json"]
DATA_ENDINGS = ["bam", "bai", "cram", "fasta", "fa", "fastq", "fq", "gz", "bz2", "zip", "tar", "tgz", "png", "jpg", "pdf", "sqlite", "h5", "rds", "so", "o", "pyc", "vcf", "sam", "tiff", "xz"]
FIXTURE_ENDINGS = ["fasta", "fa", "fastq", "fq", "sam", "vcf", "bed", "gff", "gff3", "gtf", "tsv", "csv", "tabular"]


def forward(x: Text) -> Column:
    return F.regexp_replace(filled(x), r"[\\/]+", "/")


def base_name(x: Text) -> Column:
    return F.lower(F.substring_index(forward(x), "/", -1))


def ending(x: Text) -> Column:
    return F.regexp_extract(base_name(x), r"[^.]\.([a-z0-9_]+)$", 1)


def excluded(x: Text, raw: bool = False) -> Column:
    """Whether a file isn't looked at: version control and caches, and unless ``raw``, builds and tests too."""
    parts = F.split(forward(x), "/")
    hidden = F.arrays_overlap(parts, F.array(*[F.lit(p) for p in VERSION_FOLDERS]))
    if raw:
        return hidden
    return hidden | F.arrays_overlap(parts, F.array(*[F.lit(p) for p in EXCLUDED_FOLDERS])) | forward(x).startswith("docs/_build/")


def score(x: Text, keywords: Column | None = None) -> Column:
    """Relevance of a source file by its path."""
    low, name = F.concat(F.lit("/"), F.lower(forward(x))), base_name(x)
    points = (
        F.when(low.contains("/.github/workflows/"), -120).otherwise(0)
        + F.when(low.rlike("/(?:bin|scripts?)/"), 80).otherwise(0)
        + F.when(name.startswith("readme"), 55).otherwise(0)
        + F.when(name.isin(*BUILD_FILES), 70).otherwise(0)
        + F.when(name.isin(*MAIN_FILES) | name.rlike(r"-main\.(?:c|cc|cpp)$"), 60).otherwise(0)
    )
    if keywords is None:
        return points
    key = command_key(x)
    return points + 50 * F.size(F.filter(F.array_distinct(F.transform(keywords, lambda k: command_key(k))), lambda k: (k != "") & key.contains(k)))


def test_score(x: Text, fixtures: bool, keywords: Column | None = None) -> Column:
    """Relevance of a test or example file."""
    low, name = F.concat(F.lit("/"), F.lower(forward(x))), base_name(x)
    shown = F.when(low.rlike("/(?:test|example|demo)"), 45).otherwise(0) + F.when(name.rlike("^(?:test[_-]|example|expected)"), 35).otherwise(0)
    return score(x, keywords) + shown + F.when(ending(x).isin(*FIXTURE_ENDINGS), 10 if fixtures else -25).otherwise(0)


def sample_score(content: Text) -> Column:
    """Relevance of a source file by its first 8,192 characters."""
    sample = F.substring(filled(content), 1, 8192)
    low = F.lower(sample)
    markers = sum((F.when(low.contains(m), 20).otherwise(0) for m in ("getopt", "ketopt", "argv", "argc", "subcommand")), F.lit(0))
    parsers = sum((F.when(sample.contains(m), 35).otherwise(0) for m in ("argparse", "click.command", "ArgumentParser", "optparse", "typer", "docopt")), F.lit(0))
    return parsers + markers + F.when(contains_any(low, ["usage:", "getting started"]), 30).otherwise(0)


def skip_reason(x: Text, folder: Text, size: Text, most_bytes: int) -> Column:
    """The first reason not to read a file beside a wrapper; empty if there is none."""
    path, root = forward(x), F.concat(F.regexp_replace(forward(folder), "/$", ""), F.lit("/"))
    from .text import col

    return (
        F.when(~path.startswith(root) | path.contains("/../"), "outside_folder")
        .when(path.rlike("/test[-_]data/"), "test_data")
        .when(col(size).isNull(), "missing")
        .when(ending(x).isin(*DATA_ENDINGS), "binary_or_data")
        .when(~ending(x).isin(*SOURCE_ENDINGS), "unsupported_ending")
        .when(col(size) > most_bytes, "too_large")
        .otherwise("")
    )


def sidecar_role(x: Text, root_tag: Text) -> Column:
    from .text import col

    name = base_name(x)
    return F.when((col(root_tag) == "macros") | name.contains("macro"), "macros").when((col(root_tag) == "tables") | name.startswith("tool_data_table_conf"), "data_table").when(name.endswith(".loc.sample"), "loc_sample").otherwise("")


def config_kind(x: Text, content: Text) -> Column:
    """script_template, config_template or other_template."""
    body = filled(content)
    script = ending(x).isin("py", "r", "pl", "sh", "bash", "rb", "js") | F.ltrim(body).startswith("#!") | contains_any(body, ["argparse", "suppressPackageStartupMessages"])
    return F.when(script, "script_template").when(ending(x).isin("cfg", "conf", "ini", "json", "toml", "xml", "yml", "yaml", "txt") | (F.trim(body) != ""), "config_template").otherwise("other_template")


def looks_binary(content: Column) -> Column:
    """Whether the first 8,192 bytes hold a zero byte or one control byte in twenty."""
    sample = F.hex(F.substring(content, 1, 8192))
    pairs = F.regexp_extract_all(sample, F.lit("(..)"), F.lit(1))
    control = F.size(F.filter(pairs, lambda p: (p < "20") & ~p.isin("08", "09", "0A", "0C", "0D")))
    return F.array_contains(pairs, "00") | ((F.size(pairs) > 0) & (control / F.greatest(F.size(pairs), F.lit(1)) >= 0.05))
