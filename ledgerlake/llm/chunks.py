"""Document fingerprints from content-defined chunks.

A gear hash runs over a text's UTF-8 bytes: each step doubles it and adds a random number for the byte, so
that the last 32 bytes decide its 32 bits. A chunk may end where chosen bits of the hash are zero. Chunking
is normalised: before the usual size more bits must be zero, after it fewer, and sizes stay between two
bounds. Ends depend on nearby bytes only, so text that moves keeps its chunks.

A fingerprint is the set of a text's chunk digests with the chunks' lengths. The likeness of one document to
another is the share of its length, counted over distinct chunks, that the other has too.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import parts, record

# Smallest, usual and largest chunk in bytes: small, so that a text of a few hundred bytes has several chunks.
SMALLEST, USUAL, LARGEST = 16, 48, 192
# The hash has zeros in this many leading bits at an end before, and after, the usual size.
STRICT, LOOSE = 6, 4
BLOCK = 1 << 20
_GEAR = np.random.default_rng(1234567).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling the window five times."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] += h[:-width] << np.uint32(width)
    return h


def ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end."""
    loose: list[int] = []
    strict: list[int] = []
    for at in range(0, len(data), BLOCK):
        back = min(at, 31)
        h = gear_hashes(data[at - back : at + BLOCK])[back:]
        found = np.flatnonzero(h >> np.uint32(32 - LOOSE) == 0)
        loose += (found + at + 1).tolist()
        strict += (found[h[found] >> np.uint32(32 - STRICT) == 0] + at + 1).tolist()
    cut, start, size = [], 0, len(data)
    while size - start > SMALLEST:
        i = bisect_left(strict, start + SMALLEST)
        if i < len(strict) and strict[i] < start + USUAL:
            start = strict[i]
        else:
            i = bisect_left(loose, start + USUAL)
            start = min(loose[i] if i < len(loose) else size, start + LARGEST, size)
        cut.append(start)
    if start < size:
        cut.append(size)
    return cut


def chunk_set(text: bytes) -> dict[int, int]:
    """Digest and length of each distinct chunk."""
    found, start = {}, 0
    view = memoryview(text)
    for end in ends(np.frombuffer(text, dtype=np.uint8)):
        found[xxhash.xxh3_64_intdigest(view[start:end])] = end - start
        start = end
    return found


def written(chunks: dict[int, int]) -> str:
    """A fingerprint as text: digest-length pairs in order of the digests."""
    return " ".join(f"{d:016x}-{n:x}" for d, n in sorted(chunks.items()))


def likeness(one: dict[int, int], other: dict[int, int]) -> float:
    """How much of one, by length, the other contains; two empty sets are alike."""
    total = sum(one.values())
    if not total:
        return 1.0 if not other else 0.0
    return sum(n for d, n in one.items() if d in other) / total


def bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents with a range of doc_ids as ``bucket``, ranges ascending, NULL ids first.

    The bounds of the ranges come to the driver, one for each. They need not be exact: any bounds give the
    same rows in the end.
    """
    steps = [i / buckets for i in range(1, buckets)]
    cuts = np.unique(np.array(docs.approxQuantile("doc_id", steps, max(1e-4, 0.2 / buckets)) if steps else [], dtype=np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(dtype=np.int64), side="right"), dtype="int32")

    return docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(place(F.coalesce("doc_id", F.lit(0)))))


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that and to the next document.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or all, of the
    next document in order of doc_id; the first follows the last. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next for every row. A NULL text is empty. Rows without
    a doc_id come first; equal doc_ids are ordered by text. A single row is its own next. Other columns are
    ignored, and an empty table gives no rows.

    Texts move once, to ranges of doc_ids, and are read there in order. Each range also gets the first row
    of the next one.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * parts(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = bucketed(rows, buckets)
    # One row for each range: its least doc_id. The text of that row, least among equals, goes to the range before.
    heads = sorted((r["bucket"], r["head"]) for r in placed.select("doc_id", "bucket").groupBy("bucket").agg(F.min("doc_id").alias("head")).collect())
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    before = {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}
    small = spark.createDataFrame([(b, h, before[b]) for b, h in heads], "bucket int, head long, target int")
    head_rows = (
        placed.join(F.broadcast(small.withColumnRenamed("bucket", "_b")), (F.col("bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("target", "doc_id")
        .agg(F.min("text").alias("text"))
    )
    spread = placed.select("bucket", F.lit(False).alias("guest"), "doc_id", "text").unionByName(
        head_rows.select(F.col("target").alias("bucket"), F.lit(True).alias("guest"), "doc_id", "text")
    )
    ordered = spread.repartition(parts(spark), "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text")
    return ordered.mapInArrow(neighbours, SCHEMA)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
_FIELDS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def neighbours(batches):
    """Rows of a range in order; each is set against the one after it, and the guest row only ends the range."""
    held = None
    for b in batches:
        made = []
        for guest, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("guest", "doc_id", "text")), strict=True):
            chunks = chunk_set(text.encode())
            if held is not None:
                made.append(compared(*held, text, chunks))
            held = None if guest else (doc_id, text, chunks)
        if made:
            yield record(_FIELDS, *zip(*made, strict=True))


def compared(doc_id: int | None, text: str, chunks: dict[int, int], after: str, after_chunks: dict[int, int]) -> tuple:
    half = len(text) // 2
    edited = (text[: len(text) - half] + after[:half]).encode()
    edited_chunks = chunk_set(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited).hexdigest(), written(chunks), written(edited_chunks),
        likeness(chunks, edited_chunks), likeness(chunks, after_chunks),
    )
