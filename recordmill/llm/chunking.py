"""Splitting of oversized items at natural boundaries, by byte ranges.

An item is cut into byte ranges. A range's edge moves forward from its nominal place to the first character
that no boundary pattern can span (reading as far behind the range as that takes), so a boundary lies whole in
one range, however long its run of blanks is, and what a range finds doesn't depend on where ranges begin.
Every range gives a table of its boundaries and those of one piece behind it, relative to its own start; the
running sum of the lengths turns them into offsets of the item. Cuts are then placed range by range, and the
pieces are read by offset.

A row's text is walked through its ranges where it is, without a shuffle. The ranges of files are walked in
parallel: each begins with a guess of the last cut before it, hands its own last cut to the next range, and is
walked again while that changes. Chains of cuts that begin at different places meet at the next good boundary,
so few ranges are walked twice; a file whose chains haven't met after ``ROUNDS`` is walked range by range. No
stage holds a whole file.

A cut is placed at the last paragraph end in the upper half of the room left, else the last line end there,
else the last sentence end, else the last word end; if there is none, at the last boundary of any kind in the
lower half that leaves more than the overlap; else before the last character that would not fit. Each piece
after the first begins ``overlap`` bytes before the last cut, or as many fewer as a whole character needs.

Cases: null and empty items and items that fit give no pieces; a text without any boundary is cut between
characters; line ends may be LF, CRLF or CR LF mixed; very long texts are taken whole; rows of equal ids are
cut each on its own; no rows give no rows; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import spread, written

LIMIT, OVERLAP = 6_000, 200
#: Best first: what a cut may follow. A character start is the last resort.
LEVELS = (
    re.compile(rb"\r?\n[ \t]*(?:\r?\n[ \t]*)*\r?\n"),
    re.compile(rb"\r?\n|\r"),
    re.compile(rb"[.!?][\"')\]]*[ \t]+|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f"),
    re.compile(rb"[ \t]+|\xe3\x80\x80"),
)
#: A pattern that goes over the place between two characters has one of these on both sides of it.
SPANNING = frozenset(b" \t\r\n.!?\"')]")
#: Character starts are kept in the first bytes of every so many only, so a table is far smaller than its range.
GRID = 64
#: Rounds in which the ranges of a file are walked in parallel before it is walked range by range.
ROUNDS = 4
Read = Callable[[int, int], bytes]


def checked(limit: int, overlap: int) -> None:
    if not 0 <= 2 * overlap < limit or limit < 4 * GRID:
        raise ValueError("overlap must be under half of limit, and limit at least 256 bytes")


def edge(read: Read, nominal: int, size: int, block: int = 256) -> int:
    """The first place from ``nominal`` on where a character begins that no pattern spans with the one before."""
    at = nominal
    while 0 < at < size:
        data = read(at - 1, min(size, at + block))
        for k in range(1, len(data)):
            if data[k] & 0xC0 != 0x80 and not (data[k] in SPANNING and data[k - 1] in SPANNING):
                return at + k - 1
        at += len(data) - 1
    return min(max(at, 0), size)


def boundaries(data: bytes, start: int) -> list[np.ndarray]:
    """Ends of the boundaries of each level in a range's data, and grid character starts, relative to the range."""
    found = [np.fromiter((m.end() for m in level.finditer(data)), np.int64) for level in LEVELS]
    raw = np.frombuffer(data, np.uint8)
    first = np.arange((-start) % GRID - GRID, len(raw), GRID)
    near = (first[:, None] + np.arange(4)).ravel()
    near = near[(near > 0) & (near < len(raw))]
    return [*found, near[(raw[near] & 0xC0) != 0x80]]


def table(read: Read, nominal: int, range_bytes: int, size: int, limit: int) -> tuple[int, list[np.ndarray]]:
    """(length, boundaries) of the range that begins at the edge after ``nominal``; boundaries reach one piece further."""
    start, end = edge(read, nominal, size), edge(read, min(size, nominal + range_bytes), size)
    if start >= end:
        return 0, [np.empty(0, np.int64)] * 5
    return end - start, boundaries(read(start, edge(read, min(size, end + limit), size)), start)


def walk(levels: list[np.ndarray], start: int, end: int, size: int, cut: int, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(begin, stop) of the pieces that follow cuts in [start, end), from the cut before; the last stop is the next range's."""
    pieces = []
    while cut < end:
        begin = cut - overlap if cut else 0
        if size - begin <= limit:
            return [*pieces, (begin, size)]
        top, room = begin + limit - start, cut - start
        low = room + (top - room) // 2
        last = [int(p[i - 1]) if (i := np.searchsorted(p, top, side="right")) else -1 for p in levels]
        at = next((p for p in last[:4] if p > low), -1)
        if at < 0 and max(last[:4]) > room + overlap:
            at = max(last[:4])
        if at < 0:
            at = last[4]
        if at <= room:
            raise ValueError("no character starts in a piece: the item isn't UTF-8")
        cut = at + start
        pieces.append((begin, cut))
    return pieces


def _skip(data: bytes) -> int:
    """Bytes before the first whole character."""
    return next((k for k in range(min(4, len(data))) if data[k] & 0xC0 != 0x80), 0)


def text_pieces(data: bytes, limit: int, overlap: int, range_bytes: int) -> list[tuple[int, int]]:
    """(begin, stop) of a text's pieces, walked through its ranges."""
    size, cut, out = len(data), 0, []
    read = lambda a, b: data[a:b]
    tables = [table(read, k, range_bytes, size, limit) for k in range(0, size, range_bytes)]
    ends = np.cumsum([n for n, _ in tables]).tolist()
    for (n, levels), end in zip(tables, ends, strict=True):
        if n and cut < size:
            pieces = walk(levels, end - n, end, size, cut, limit, overlap)
            out += pieces
            cut = pieces[-1][1] if pieces else cut
    return out


def split_texts(values: DataFrame, item_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = 16_384) -> DataFrame:
    """(item, piece_no, begin, stop, piece) of every text of more than ``limit`` bytes.

    ``begin`` and ``stop`` are byte offsets in the text's UTF-8 form.
    """
    checked(limit, overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_buffer().to_pybytes()
                bounds = text_pieces(data, limit, overlap, range_bytes)
                starts = [b + (_skip(data[b : b + 4]) if k else 0) for k, (b, _) in enumerate(bounds)]
                stops = [e for _, e in bounds]
                parts = pa.array([data[a:b].decode("utf-8") for a, b in zip(starts, stops, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(bounds), pa.string()), pa.array(range(len(bounds)), pa.int64()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), parts], names=["item", "piece_no", "begin", "stop", "piece"])

    big = values.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(F.octet_length("text") > limit)
    return spread(big).mapInArrow(run, "item string, piece_no long, begin long, stop long, piece string")


def _reader(path: str):  # noqa: ANN202
    """An open file of any file system that Arrow knows by its URI, or a path of a shared folder."""
    system, place = FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)
    return system.open_input_file(place)


_LISTS = ("p", "l", "s", "w", "c")


def _tables(batches: Iterator[pa.RecordBatch], range_bytes: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows (item, size, range_no) to boundary tables."""
    for batch in batches:
        for row in batch.to_pylist():
            with _reader(row["item"]) as f:
                n, levels = table(lambda a, b: f.read_at(b - a, a), row["range_no"] * range_bytes, range_bytes, row["size"], limit)  # noqa: B023
            yield pa.RecordBatch.from_pydict({"item": [row["item"]], "size": [row["size"]], "range_no": [row["range_no"]], "length": [n]} | {c: pa.array([x], pa.list_(pa.int64())) for c, x in zip(_LISTS, levels, strict=True)})


def _walk_rows(limit: int, overlap: int, alone: bool):  # noqa: ANN202
    """Tables with a start and the last cut before (``entry``) to (item, range_no, entry, leave, begins, stops).

    If not ``alone``, rows come sorted by item and range, and each takes its entry from the row before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cut = None, 0
        for batch in batches:
            names = batch.schema.names
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in names if c not in _LISTS}
                if alone or row["item"] != now:
                    now, cut = row["item"], row["entry"] if alone else 0
                entry = cut
                if cut < row["size"]:
                    levels = [batch.column(c)[k].values.to_numpy() for c in _LISTS]
                    pieces = walk(levels, row["start"], row["start"] + row["length"], row["size"], cut, limit, overlap)
                    cut = pieces[-1][1] if pieces else cut
                else:
                    pieces = []
                yield pa.RecordBatch.from_pydict({"item": [row["item"]], "range_no": [row["range_no"]], "entry": [entry], "leave": [cut], "begins": pa.array([[b for b, _ in pieces]], pa.list_(pa.int64())), "stops": pa.array([[e for _, e in pieces]], pa.list_(pa.int64()))})

    return run


_WALKED = "item string, range_no long, entry long, leave long, begins array<long>, stops array<long>"


def _file_cuts(tables: DataFrame, limit: int, overlap: int) -> DataFrame:
    """(item, range_no, begins, stops) of all ranges."""
    by = ["item", "range_no"]
    entries = tables.select("item", "range_no", "start", F.col("start").alias("entry"))
    walked = None
    for k in range(ROUNDS):
        fresh = tables.join(entries.select(*by, "entry"), by).mapInArrow(_walk_rows(limit, overlap, True), _WALKED)
        if walked is not None:
            fresh = fresh.union(walked.join(entries.select(*by), by, "left_anti"))
        walked = written(fresh, f"walked-{k}")
        before = F.lag("leave").over(Window.partitionBy("item").orderBy("range_no"))  # rows are ranges, without their tables
        moved = walked.select(*by, F.coalesce(before, F.lit(0)).alias("now"), "entry")
        entries = written(moved.where("now <> entry").select(*by, F.col("now").alias("entry")), f"entries-{k}")
        if entries.isEmpty():
            return walked.select(*by, "begins", "stops")
    open_items = entries.select("item").distinct()
    rest = tables.join(open_items, "item", "left_semi").withColumn("entry", F.lit(0).cast("long")).repartition("item").sortWithinPartitions(*by)
    return walked.join(open_items, "item", "left_anti").union(rest.mapInArrow(_walk_rows(limit, overlap, False), _WALKED)).select(*by, "begins", "stops")


def split_files(spark: SparkSession, files: list[tuple[str, int]], limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = 8 << 20) -> DataFrame:
    """Pieces of UTF-8 text files that all workers can open, given as (path or URI, size in bytes).

    Each worker reads its range and what its edges need; pieces are read by offset, a group of neighbours at a time.
    """
    checked(limit, overlap)
    listed = spark.createDataFrame(files, "item string, size long").where(F.col("size") > limit)
    ranges = listed.select("item", "size", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("size") - 1) / range_bytes).cast("long"))).alias("range_no"))
    parts = max(1, min(10_000, sum(-(-size // range_bytes) for _, size in files)))
    ranges = ranges.repartition(parts, "item", "range_no")
    lists = ", ".join(f"{c} array<long>" for c in _LISTS)
    found = written(ranges.mapInArrow(lambda batches: _tables(batches, range_bytes, limit), f"item string, size long, range_no long, length long, {lists}"), "tables")
    ahead = Window.partitionBy("item").orderBy("range_no")
    starts = found.select("item", "range_no", (F.sum("length").over(ahead) - F.col("length")).alias("start"))  # rows are ranges, without their tables
    cuts = written(_file_cuts(found.join(starts, ["item", "range_no"]), limit, overlap), "cuts")
    numbered = cuts.select("item", "range_no", (F.sum(F.size("stops")).over(ahead) - F.size("stops")).alias("first"))
    pieces = cuts.join(numbered, ["item", "range_no"]).where(F.size("stops") > 0)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _reader(row["item"]) as f:
                    for lo in range(0, len(row["stops"]), 512):
                        begins, stops = row["begins"][lo : lo + 512], row["stops"][lo : lo + 512]
                        data, base = f.read_at(stops[-1] - begins[0], begins[0]), begins[0]
                        starts = [b + (_skip(data[b - base : b - base + 4]) if b else 0) for b in begins]
                        texts = [data[a - base : e - base].decode("utf-8") for a, e in zip(starts, stops, strict=True)]
                        yield pa.RecordBatch.from_pydict({"item": [row["item"]] * len(texts), "piece_no": pa.array(range(row["first"] + lo, row["first"] + lo + len(texts)), pa.int64()), "begin": starts, "stop": stops, "piece": texts})

    return pieces.select("item", "first", "begins", "stops").repartition(parts, "item", "first").mapInArrow(fetch, "item string, piece_no long, begin long, stop long, piece string")
