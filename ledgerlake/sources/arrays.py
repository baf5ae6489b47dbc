"""Large files that hold one JSON array, read by many tasks.

Spark's text reader cuts a file into ranges of bytes and hands on what lies between closing braces, from any file
system. A first pass writes this as chunks of some megabytes. For each chunk it counts the quotes, and how the depth of
brackets changes, once for a start inside a string and once for one outside. Running sums over these small rows
tell for each chunk whether it starts in a string and how deep. The second pass cuts the chunks at the commas of the
array. What lies across the border of two chunks, or of many, is put together by a join of those pieces only.
Chunks are written once, so it does not matter how Spark cuts the files when they are read again.

A file counts as an array if its brackets close, nothing stands around it, and each element is JSON by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.quarantine import UNREADABLE_FILE
from ledgerlake.session import stage

BRACE = "}"
# Bytes of a chunk, about.
CHUNK = 4 << 20
BLANK = b" \t\r\n"
_BLANKS = np.isin(np.arange(256), list(BLANK))
_STEP = np.zeros(256, dtype=np.int64)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"[]{},")] = True


def quotes_of(data: np.ndarray) -> np.ndarray:
    """Places of quotes that no backslash takes away."""
    quotes = np.flatnonzero(data == 34)
    slash = data == 92
    if not len(quotes) or not slash.any():
        return quotes
    plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
    before = np.where(quotes > 0, plain[quotes - 1], -1)
    return quotes[(quotes - 1 - before) % 2 == 0]


def marks_of(data: np.ndarray, inside: bool) -> tuple[np.ndarray, int]:
    """Places of brackets and commas outside of strings, and the number of quotes."""
    quotes = quotes_of(data)
    marks = np.flatnonzero(_MARK[data])
    outside = (np.searchsorted(quotes, marks) + inside) % 2 == 0
    return marks[outside], len(quotes)


class Cutter:
    """Cuts one chunk at the commas of the array; fed with its bytes in any number of steps."""

    def __init__(self, inside: bool, depth: int) -> None:
        self.inside, self.depth = inside, depth
        # What the open element began with, if that lies in this chunk, and its bytes so far.
        self.began: str | None = None
        self.text: list[bytes] = []
        self.opens = self.closes = self.odd = 0

    def feed(self, raw: bytes) -> Iterator[tuple[str | None, str | None, bytes]]:
        """(began, ended, text) of the elements that end here."""
        data = np.frombuffer(raw, dtype=np.uint8)
        marks, quotes = marks_of(data, self.inside)
        step = _STEP[data[marks]]
        after = self.depth + np.cumsum(step)
        cut = np.flatnonzero(((step == 0) & (after == 1)) | ((step > 0) & (after == 1)) | ((step < 0) & (after <= 0)))
        at = 0
        for place, kind, depth in zip(marks[cut].tolist(), step[cut].tolist(), after[cut].tolist(), strict=True):
            char = chr(data[place])
            self.text.append(raw[at:place])
            at = place + 1
            if kind > 0:
                self.opens += 1
                self.odd += char != "["
                self.odd += bool(b"".join(self.text).strip(BLANK))
            else:
                yield self.began, char, b"".join(self.text)
                if kind < 0:
                    self.closes += 1
                    self.odd += char != "]" or depth < 0
            self.began, self.text = (char if kind >= 0 else None), []
        self.text.append(raw[at:])
        self.depth = int(after[-1]) if len(after) else self.depth
        self.inside ^= bool(quotes % 2)

    def rest(self) -> tuple[str | None, None, bytes] | None:
        """What is open at the end of the range: a piece of an element, or nothing behind the array."""
        text = b"".join(self.text)
        if self.depth >= 1:
            return self.began, None, text
        self.odd += bool(text.strip(BLANK))
        return None


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """What lies before each closing brace, in order within a range of a file, with the range."""
    read = spark.read.format("text").option("lineSep", BRACE).load(list(paths))
    return read.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_block_start").alias("at"),
    )


def _stretches(b: pa.RecordBatch) -> Iterator[tuple[tuple, bytes]]:
    """((path, name, bytes, at), bytes) for each run of a batch's rows that lie in one range, a brace after each row."""
    keys = list(zip(*(b.column(c).to_pylist() for c in ("path", "name", "bytes", "at")), strict=True))
    values, first = b.column("value").to_pylist(), 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[first]:
            yield keys[first], b"}".join(values[first:i]) + b"}"
            first = i


def chunks(pieces: DataFrame) -> DataFrame:
    """(path, name, bytes, at, seq, length, quotes, outside, inside, first, data), in order by at and seq within a file.

    ``first`` is the first character that is not blank. ``outside`` and ``inside`` are the changes of depth.
    """
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 7, pa.string(), pa.binary()]
    names = ["path", "name", "bytes", "at", "seq", "length", "quotes", "outside", "inside", "first", "data"]

    def row(key: tuple, seq: int, raw: bytes) -> pa.RecordBatch:
        data = np.frombuffer(raw, dtype=np.uint8)
        change = []
        for inside in (False, True):
            marks, quotes = marks_of(data, inside)
            change.append(int(_STEP[data[marks]].sum()))
        seen = np.flatnonzero(~_BLANKS[data])
        values = (*key, seq, len(raw), quotes, *change, chr(data[seen[0]]) if len(seen) else None, raw)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    def run(batches):
        key, seq, held, size = None, 0, [], 0
        for b in batches:
            for found, raw in _stretches(b):
                if key is not None and (found != key or size >= CHUNK):
                    yield row(key, seq, b"".join(held))
                    seq, held, size = seq + 1, [], 0
                if found != key:
                    key, seq = found, 0
                held.append(raw)
                size += len(raw)
        if key is not None:
            yield row(key, seq, b"".join(held))

    return pieces.mapInArrow(run, "path string, name string, bytes long, at long, seq long, length long, quotes long, outside long, inside long, first string, data binary")


def starts(found: DataFrame) -> DataFrame:
    """(path, at, seq, starts_inside, depth, bare): where each chunk starts; whether it ends its file without a brace."""
    place = Window.partitionBy("path").orderBy("at", "seq")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    light = found.drop("data").withColumn("starts_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    light = light.withColumn("change", F.when(F.col("starts_inside"), F.col("inside")).otherwise(F.col("outside")))
    upto = F.sum("length").over(place)
    return light.select(
        "path", "at", "seq", "starts_inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"), (upto > F.col("bytes")).alias("bare")
    )


CUT = "path string, name string, at long, seq long, part int, began string, ended string, text binary, opens int, closes int, odd int, open_end boolean"


def cut_chunks(found: DataFrame) -> DataFrame:
    """Elements and pieces of elements (began or ended is NULL), and a row with a chunk's counts (text is NULL)."""
    names = [c.split()[0] for c in CUT.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds = [types[c.split()[1]] for c in CUT.split(", ")]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                path, name, at, seq, inside, depth, bare, raw = (b.column(c)[i].as_py() for c in ("path", "name", "at", "seq", "starts_inside", "depth", "bare", "data"))
                cutter = Cutter(inside, depth)
                rows = [(path, name, at, seq, 0, *e, None, None, None, None) for e in cutter.feed(raw[:-1] if bare else raw)]
                if rest := cutter.rest():
                    rows.append((path, name, at, seq, 1, *rest, None, None, None, None))
                rows.append((path, name, at, seq, 2, None, None, None, cutter.opens, cutter.closes, cutter.odd, bool(rest)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    ready = found.select("path", "name", "at", "seq", "data").join(starts(found), ["path", "at", "seq"])
    return ready.mapInArrow(run, CUT)


def array_records(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Records of large array files as ``json_records`` has them, and the paths of files that do not begin as an array.

    A file that is not JSON gives one row with the reason and, in place of its text, its name. The files are read
    once; their chunks and their elements go through the scratch folder. The driver gets a row for each other file.
    """
    found = stage(chunks(_pieces(spark, paths)), "array-chunks")
    first = found.groupBy("path").agg(F.min_by("first", F.when(F.col("first").isNotNull(), F.struct("at", "seq"))).alias("first"))
    # A row for each large file that is none of this.
    others = [r["path"] for r in first.filter(F.coalesce("first", F.lit("")) != "[").collect()]
    arrays = found.filter(~F.col("path").isin(others)) if others else found
    cut = stage(cut_chunks(arrays), "array-elements")
    whole = cut.filter("began IS NOT NULL AND ended IS NOT NULL").select("path", "name", "began", "ended", F.col("text").cast("string").alias("text"))
    # Pieces in order: one that has a beginning opens an element, the others go on with it.
    partial = cut.filter("text IS NOT NULL AND (began IS NULL OR ended IS NULL)")
    key = ["path", "at", "seq", "part"]
    order = Window.partitionBy("path").orderBy("at", "seq", "part")
    places = partial.select(*key, F.count("began").over(order).alias("nth"))
    texts = partial.select(*key, "name", "began", "ended", "text").join(places, key)
    joined = texts.groupBy("path", "name", "nth").agg(
        F.max("began").alias("began"), F.max("ended").alias("ended"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "seq", "part", F.col("text").cast("string").alias("text")))), lambda x: x["text"]), "").alias("text"),
    )
    elements = whole.unionByName(joined.drop("nth")).withColumn("text", F.trim(F.col("text"), F.lit(" \t\r\n")))
    # An empty array has one empty element.
    elements = elements.filter((F.col("text") != "") | (F.col("began") != "[") | (F.col("ended") != "]") | F.col("ended").isNull())
    is_object = F.col("text").startswith("{")
    # One value: two of them without a comma between do not make an array of one.
    readable = F.json_array_length(F.concat(F.lit("["), "text", F.lit("]"))) == 1
    wrong = elements.groupBy("path").agg(F.count_if(~F.coalesce(readable, F.lit(False)) | F.col("began").isNull() | F.col("ended").isNull()).alias("wrong"))
    last = F.max_by("open_end", F.struct("at", "seq"))
    files = cut.filter("part = 2").groupBy("path", "name").agg(
        F.sum("opens").alias("opens"), F.sum("closes").alias("closes"), F.sum("odd").alias("odd"), last.alias("open_end")
    )
    sound = (F.col("opens") == 1) & (F.col("closes") == 1) & (F.col("odd") == 0) & ~F.col("open_end") & (F.coalesce("wrong", F.lit(0)) == 0)
    judged = stage(files.join(wrong, "path", "left").select("path", "name", sound.alias("sound")), "array-files")
    payload = F.get(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>"), F.lit(0))
    records = elements.filter(is_object).join(judged.filter("sound").select("path"), "path", "left_semi")
    good = records.select(F.col("name").alias("source_file"), F.lit(None).cast("string").alias("reject_reason"), payload.alias("raw_payload"))
    bad = judged.filter("NOT sound").select(F.col("name").alias("source_file"), F.lit(UNREADABLE_FILE).alias("reject_reason"), F.col("name").alias("raw_payload"))
    return good.unionByName(bad), others
