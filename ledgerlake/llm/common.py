"""What several text operators share: reading documents, staged tables, word hashes over byte buffers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir

# The characters that separate words, [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
# Hashing works on stretches of about this many bytes, so a very long text needs no large buffer.
STRETCH = 1 << 20
# Bytes of an Arrow batch that a function is given at once.
BATCH = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """A text as UTF-8 bytes; NULL counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text bytes, without any other column a caller's table may have."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def staged(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """The frame as a table in the cluster's shared folder: computed once, and read again after a lost executor.

    With ``free`` the driver collects its garbage afterwards, upon which Spark removes the shuffle files behind the
    table; else they stay until the driver happens to. They stay too while the caller has a name for the frame.
    """
    spark, schema, path = df.sparkSession, df.schema, scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    if free:
        del df
        spark.range(1).collect()  # the scheduler holds on to its last job until the next one
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_rows(df: DataFrame, batch: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Each Arrow batch through a function, in parts of about BATCH bytes; nothing is kept between them."""
    owner = batch.__qualname__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken_over(owner)
        for b in batches:
            for some in sliced(b):
                if (out := batch(some)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def sliced(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about BATCH bytes, none empty."""
    rows = max(1, int(BATCH * b.num_rows / max(1, b.nbytes)))
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


# What a worker process keeps from one task to the next: one operator's things, gone when another's task begins.
_HELD: dict[str, object] = {}
_OWNER: list[str] = []


def taken_over(owner: str) -> None:
    """Begin a task of an operator; what another one has kept goes, and its memory back to the system."""
    if _OWNER == [owner]:
        return
    _OWNER[:] = [owner]
    _HELD.clear()
    given_back()


def given_back() -> None:
    """Memory that is no longer in use, back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


def held(name: str, make: Callable[[], object]):
    """A thing that is made once for a worker process and kept while its operator's tasks follow each other."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def fresh_name(columns: Sequence[str], name: str) -> str:
    """A column name that a caller's table does not have, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def record(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=t) for (_, t), c in zip(schema, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in schema])


# Random words for bytes, and powers of an odd number with their inverses modulo 2^64. They come from a
# fixed seed: every task must hash alike.
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that lets every bit act on every other."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 2 * STRETCH)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span data[start:end], from one running sum over the buffer."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def stretches(text: bytes) -> Iterator[np.ndarray]:
    """The bytes in stretches that end at a separator. One word longer than a stretch stays whole."""
    data = np.frombuffer(text, dtype=np.uint8)
    at = 0
    while at < len(data):
        end = at + STRETCH
        while end < len(data):
            gaps = np.flatnonzero(_SPACE[data[end : end + STRETCH]])
            if len(gaps):
                end += int(gaps[0]) + 1
                break
            end += STRETCH
        yield data[at:end]
        at = end


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer."""
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    return np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)


def word_hashes(text: bytes) -> np.ndarray:
    """One hash for each word of a text, in order; equal words have equal hashes."""
    found = [span_hashes(d, *word_spans(d)) for d in stretches(text)]
    return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n consecutive word hashes."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(_ODD) + words[i : i + count]
    return mix(h)
