"""Folders of files as tables: packages, wrappers, sources with their relevance, archives."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup, paths

_PLACE = "path string, modificationTime timestamp, length long"


def files(spark: SparkSession, root: str, glob: str = "*", content: bool = True) -> DataFrame:
    """(path, length, content) of all files below a folder; without content none is opened."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return df.select("path", "length", "content") if content else df.select("path", "length")


def packages(spark: SparkSession, root: str, mark: str = ".shed.yml") -> DataFrame:
    """(package_dir) of every folder with the mark file.

    Spark's own listing leaves out names that begin with a dot, so the file system is asked; like any
    listing this is the driver's work, and no file is opened.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    found, walk = [], place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    while walk.hasNext():
        path = walk.next().getPath()
        if path.getName() == mark:
            found.append((path.getParent().toString(),))
    return spark.createDataFrame(found, "package_dir string")


def wrappers(spark: SparkSession, root: str) -> DataFrame:
    """(path, package_dir, name, text) of XML files that are tools: no macro files, root tag ``tool``."""
    xml = files(spark, root, "*.xml").withColumn("text", F.decode("content", "utf-8")).withColumn("name", F.substring_index("path", "/", -1))
    named = xml.where(~F.lower("name").contains("macro"))
    return named.where(markup.xml_root("text") == "tool").select("path", F.regexp_replace("path", "/[^/]*$", "").alias("package_dir"), "name", "text")


def sources(spark: SparkSession, root: str, keywords: list[str], most_bytes: int = 200_000, raw: bool = False) -> DataFrame:
    """(relpath, length, score, text): text files that are looked at, most relevant first by ``score``."""
    base = F.regexp_replace(F.lit(root), "/+$", "")
    f = files(spark, root).withColumn("relpath", F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/+", "/"), F.concat(F.lit("^"), F.regexp_replace(base, "^[a-z]+:/+", "/"), F.lit("/")), ""))
    kept = f.where(~paths.excluded("relpath", raw) & (F.col("length") <= most_bytes) & ~paths.looks_binary(F.col("content")))
    text = F.decode("content", "utf-8")
    words = F.array(*[F.lit(k) for k in keywords]).cast("array<string>")
    return kept.select("relpath", "length", (paths.score("relpath", words) + paths.sample_score(text)).alias("score"), text.alias("text"))


def archive_members(spark: SparkSession, root: str, glob: str = "*.{tar.gz,tgz,zip}", most: int = 5000) -> DataFrame:
    """(path, member, size) of archives, up to ``most`` members of each, which is where listing an archive ends."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    if path.endswith(".zip"):
                        with zipfile.ZipFile(io.BytesIO(content)) as z:
                            rows += [(path, i.filename, i.file_size) for i in z.infolist()[:most]]
                    else:
                        with tarfile.open(fileobj=io.BytesIO(content)) as t:
                            rows += [(path, m.name, m.size) for _, m in zip(range(most), t, strict=False)]
                except (OSError, tarfile.TarError, zipfile.BadZipFile):
                    rows.append((path, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ([], [], []), (pa.string(), pa.string(), pa.int64()), strict=True)], names=["path", "member", "size"])

    return files(spark, root, glob).select("path", "content").mapInArrow(members, "path string, member string, size long")


def user_tools(spark: SparkSession, root: str, kind: str = "UserTool") -> DataFrame:
    """(path, text) of YAML files whose class ends in ``kind``; broken ones are left out."""
    text = files(spark, root, "*.{yml,yaml}").select("path", F.decode("content", "utf-8").alias("text"))
    return text.where(markup.yaml_features("text")["kind"].endswith(kind))


def package_files(spark: SparkSession, root: str) -> DataFrame:
    """(package_dir, names): each package's tool files, sorted."""
    return wrappers(spark, root).groupBy("package_dir").agg(F.array_sort(F.collect_list("name")).alias("names"))


def known_terms(spark: SparkSession, built_in: list[str], path: str | None = None) -> DataFrame:
    """(term): a list and the lines of a file, without comments and blanks, each once."""
    base = spark.createDataFrame([(t,) for t in built_in], "term string")
    if path is None:
        return base.distinct()
    extra = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("term")).where("term <> ''")
    return base.union(extra).distinct()
