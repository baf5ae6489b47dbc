"""Packing documents into sequences along a space-filling curve.

Each document's token ids are counted into a hashed vector of length one, which random signs project to a
few dimensions. The cell of the projection has a place on a Hilbert curve, and a range sort by it puts
similar documents next to each other. Laid end to end in that order, the ids are cut at every multiple of
the sequence length, so that only the very last sequence can need padding.

Only (key, length) rows are sorted. The ids are written once, as two bytes each where the vocabulary allows
it, and meet their position in one join on a row number.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import held, map_rows, parts, record, span_hashes, staged, stretches, text_or_empty, word_spans

LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS = 4, 12
# Words whose ids a worker process remembers at most, between batches: some 40 bytes each.
REMEMBERED = 1_000_000
# Bytes of text whose words are looked up together.
AT_ONCE = 4 << 20
# Marks that no character combines with and no letter pattern of the tokenizer starts with.
MARKS = ".,;:!?#*$%&|\")]}"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (n x dimensions, unsigned, below 2^bits).

    Works on all cells at once: turn and mirror the axes from the highest bit down, take the Gray code, and
    interleave the bits of the axes.
    """
    axes = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(axes)):
            high = (axes[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (axes[0] ^ axes[i]) & below)
            axes[0] = axes[0] ^ np.where(high, below, swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(cells), dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint64(level)) & one, np.uint64((1 << level) - 1), np.uint64(0))
    key = np.zeros(len(cells), dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << one | ((axis ^ flip) >> np.uint64(level)) & one
    return key.astype(np.int64)


def signs(n: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A row of random signs for each token id; the same in every task."""
    return np.random.default_rng(97).choice(np.array([-1, 1], dtype=np.float32), (n, dimensions))


def projection(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The document's vector of token counts, scaled to length one, in a few random directions."""
    kinds, counts = np.unique(ids, return_counts=True)
    weight = counts.astype(np.float32)
    return (weight @ table[kinds]) / np.sqrt(weight @ weight)


def cells(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of projected points; the arctangent bounds every coordinate."""
    return np.minimum((np.arctan(points) / np.pi + 0.5) * (1 << bits), (1 << bits) - 1).astype(np.uint64)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its size, one after another."""
    upto = np.cumsum(size)
    return np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


class WordIds:
    """Token ids of the words that white space separates, learned batch by batch.

    The tokenizer drops white space and never looks across it. Nor does it look from a letter or digit to a
    mark after it, so a word that ends in such marks is the word without them and the marks. Capital ASCII
    letters have the ids of small ones. Words are known by their 64-bit hash, in order; a batch's ids are copied
    from the learned ones by array operations.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        n = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.signs = signs(n)
        # Ids that end a word; letters alone have one, at their end.
        self.ending = np.zeros(n, dtype=bool)
        self.ending[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.ids = np.zeros(0, dtype=self.dtype)
        self.start, self.size, self.met = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def forget(self) -> None:
        """Keep only what was met in two batches or more."""
        kept = self.met > 1
        self.hashes, start, self.size = self.hashes[kept], self.start[kept], self.size[kept]
        self.ids = self.ids[ranges(start, self.size)]
        self.start = np.cumsum(self.size) - self.size
        self.met = np.ones(len(self.size), dtype=np.int64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where words are, by their hashes; -1 for those not learned."""
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        return np.where(known, at, -1)

    def encoded(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of parts of words, by the tokenizer. Letters go many words to a call, split where a word ends."""
        out: dict[str, bytes] = {}
        letters = [p for p in parts if p.isalpha()]
        width = self.dtype.itemsize
        groups = [letters[at : at + 200] for at in range(0, len(letters), 200)]
        for some, found in zip(groups, self.ids_by_call([" ".join(g) for g in groups], 25), strict=True):
            ids = np.array(found, dtype=self.dtype)
            stops = ((np.flatnonzero(self.ending[ids]) + 1) * width).tolist()
            if len(stops) == len(some):
                raw = ids.tobytes()
                out.update((p, raw[a:b]) for p, a, b in zip(some, [0, *stops], stops, strict=False))
        rest = [p for p in parts if p not in out]
        for p, found in zip(rest, self.ids_by_call(rest, 2000), strict=True):
            out[p] = np.array(found, dtype=self.dtype).tobytes()
        return out

    def ids_by_call(self, texts: list[str], at_once: int) -> Iterator[list[int]]:
        """The ids of texts, a few texts to a call: what a call returns takes many times their memory."""
        for at in range(0, len(texts), at_once):
            for e in self.tokenizer.encode_batch_fast(texts[at : at + at_once], add_special_tokens=False):
                yield e.ids

    @staticmethod
    def parted(word: str) -> tuple[str, ...]:
        core = word.rstrip(MARKS)
        if not core or "<|" in word or not core[-1].isalnum() or not core[-1].lower()[-1].isalnum():
            return (word,)
        key = core.lower() if core.isascii() else core
        return (key, word[len(core) :]) if len(core) < len(word) else (key,)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Put new words among the known ones; both are in the order of their hashes."""
        parts = [self.parted(w) for w in words]
        ids = self.encoded(list(set(chain.from_iterable(parts))))
        made = [ids[ps[0]] if len(ps) == 1 else ids[ps[0]] + ids[ps[1]] for ps in parts]
        size = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // self.dtype.itemsize
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.start = np.insert(self.start, at, len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.met = np.insert(self.met, at, 0)
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(made), dtype=self.dtype)))

    def ids_of(self, texts: list[bytes], end_id: int) -> list[np.ndarray]:
        """Each text's ids and the end id."""
        if len(self.hashes) > REMEMBERED:
            self.forget()
        joined, at = b"\n".join(texts), 0
        hashes, starts, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for data in stretches(joined):
            a, b = word_spans(data)
            hashes.append(span_hashes(data, a, b))
            starts.append(a + at)
            ends.append(b + at)
            at += len(data)
        starts, ends = np.concatenate(starts), np.concatenate(ends)
        kinds, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        places = self.places(kinds)
        new = np.flatnonzero(places < 0)
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self.learn(kinds[new], [joined[a:b].decode() for a, b in spans])
            places = self.places(kinds)
        self.met[places] += 1
        word = places[which]
        size = self.size[word]
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[ranges(self.start[word], size)]
        stop = upto[np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))].tolist()
        end = np.array([end_id], dtype=self.dtype)
        return [np.concatenate((ids[a:b], end)) for a, b in zip([0, *stop], stop, strict=False)]


def word_ids(tokenizer: str) -> WordIds:
    """One for a worker process, so that later tasks know the words of earlier ones."""
    return held(f"words-{hash(tokenizer)}", lambda: WordIds(tokenizer))


def groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in groups of about AT_ONCE bytes, which bounds the arrays made for them."""
    size, first = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= AT_ONCE:
            yield texts[first : i + 1]
            size, first = 0, i + 1
    if first < len(texts):
        yield texts[first:]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, n, key, wide, ids): every row's ids with the end id, and its place on the curve."""
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    out = [("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("wide", pa.bool_()), ("ids", pa.binary())]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        known = word_ids(source.value)
        ids = [i for some in groups(b.column("text").to_pylist()) for i in known.ids_of(some, end_id)]
        keys = hilbert(cells(np.stack([projection(i, known.signs) for i in ids])), BITS)
        wide = [known.dtype.itemsize == 4] * len(ids)
        return record(out, b.column("row"), b.column("doc_id"), [len(i) for i in ids], keys, wide, [i.tobytes() for i in ids])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
    )
    return map_rows(rows, batch, "row long, doc_id long, n long, key long, wide boolean, ids binary")


def positions(rows: DataFrame) -> DataFrame:
    """(row, at): where each row's ids begin when all rows lie end to end along the curve.

    Partitions of the range sort count from 0. The driver adds up their totals, one number for each.
    """
    spark = rows.sparkSession

    def run(batches):
        at, part = 0, TaskContext.get().partitionId()
        for b in batches:
            n = b.column("n").to_numpy()
            ends = at + np.cumsum(n)
            yield record([("part", pa.int32()), ("row", pa.int64()), ("at", pa.int64()), ("n", pa.int64())], np.full(len(n), part), b.column("row"), ends - n, n)
            at = int(ends[-1]) if len(n) else at

    light = rows.select("key", "row", "n").repartitionByRange(parts(spark), "key", "row").sortWithinPartitions("key", "row")
    local = staged(light.mapInArrow(run, "part int, row long, at long, n long"), "curve")
    totals = sorted((r["part"], r["total"]) for r in local.groupBy("part").agg(F.sum("n").alias("total")).collect())
    offsets = [(p, o) for (p, _), o in zip(totals, accumulate((t for _, t in totals), initial=0), strict=False)]
    starts = spark.createDataFrame(offsets, "part int, offset long")
    return local.join(F.broadcast(starts), "part").select("row", (F.col("at") + F.col("offset")).alias("at"))


def packed(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length.

    Every id lies in one piece. Sequences are full but for the last, which is padded to ``length`` unless
    its size is a power of two. NULL and empty texts have the end id alone. Rows without a doc_id and
    repeated rows are packed each on their own; other columns are ignored. Equal keys are ordered by row.
    """
    rows = staged(tokenized(docs, tokenizer_path, end_id), "token-ids")
    place = staged(positions(rows), "positions")
    total = rows.agg(F.sum("n")).first()[0] or 0
    rest = total % length
    last, last_length = total // length, rest if rest & (rest - 1) == 0 else length
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"]
    out = [(n, pa.int64()) for n in names]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        made: list[tuple] = []
        for doc_id, n, wide, ids, at in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "wide", "ids", "at")), strict=True):
            ids = np.frombuffer(ids, dtype="<u4" if wide else "<u2").astype("<u4")
            start = 0
            while start < n:
                sequence, offset = divmod(at + start, length)
                size = min(n - start, length - offset)
                crc = zlib.crc32(ids[start : start + size].tobytes())
                made.append((doc_id, start, size, crc, n, sequence, offset, last_length if sequence == last else length))
                start += size
        return record(out, *zip(*made, strict=True))

    return map_rows(rows.hint("merge").join(place, "row").select("doc_id", "n", "wide", "ids", "at"), batch, ", ".join(f"{n} long" for n in names))
