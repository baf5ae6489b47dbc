"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A vocabulary with scores is read from a sentencepiece model file. A text's symbols are its characters,
with spaces as a visible mark and one mark before the text. The best-scored adjacent pair, leftmost first,
is merged until no pair is in the vocabulary. Each merge takes one symbol away, so the count is the number
of symbols at the start minus the merges. A character the vocabulary lacks counts one for each UTF-8 byte.

No piece has the mark after another character, so merges never cross from a word into the mark of the next,
and a text's count is the sum over its words. A task remembers the counts of words it has met; the memory
is emptied when full and changes no result.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import held, map_rows, record

MARK = "▁"
CONTEXT = 4096
# Words remembered by a task, and the longest that is.
REMEMBERED, REMEMBERED_LENGTH = 1_000_000, 64


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        length = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at : at + length]
        at += length


# Field numbers and piece types of the model format.
PIECES, NORMALIZER, PIECE, SCORE, TYPE = 1, 3, 1, 2, 3
NORMAL = 1
CHARSMAP, DUMMY_PREFIX, DROP_SPACES = 2, 3, 4


class Memory(dict):
    """Counts by word, filled on first use."""

    def __init__(self, prefix: str, count) -> None:
        super().__init__()
        self.prefix, self.count = prefix, count

    def __missing__(self, word: str) -> int:
        n = self.count(self.prefix + word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


class PieceCounter:
    """Counts tokens by the merges of a sentencepiece byte-pair model with byte fallback."""

    def __init__(self, model: bytes) -> None:
        scored: dict[str, float] = {}
        for number, value in fields(model):
            if number == PIECES:
                piece = dict(fields(value))
                if (kind := piece.get(TYPE, NORMAL)) == NORMAL:
                    scored[piece[PIECE].decode()] = struct.unpack("<f", piece[SCORE])[0]
                elif kind in (4, 5):
                    raise ValueError("user-defined and unused pieces are not supported")
            elif number == NORMALIZER:
                spec = dict(fields(value))
                if spec.get(CHARSMAP) or spec.get(DROP_SPACES, 1) or not spec.get(DUMMY_PREFIX, 1):
                    raise ValueError("only models that keep the text as it is and put one space before it are supported")
        ranks = {s: i for i, s in enumerate(sorted(set(scored.values()), reverse=True))}
        self.rank = {p: ranks[s] for p, s in scored.items()}
        inner = [p for p in self.rank if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in inner):
            raise ValueError("a piece spans words")
        self.lines = not any("\n" in p for p in inner)
        self.newline = self.symbol("\n")
        self.marked, self.bare = Memory(MARK, self.merged), Memory("", self.merged)

    def symbol(self, char: str) -> int:
        return 1 if char in self.rank else len(char.encode())

    def merged(self, segment: str) -> int:
        """Symbols left of a segment when no adjacent pair can be merged."""
        n = len(segment)
        rank = self.rank
        if n < 2:
            return self.symbol(segment) if n else 0
        piece: list[str | None] = list(segment)
        cost = [1 if c in rank else len(c.encode()) for c in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        width = n + 1
        heap = [r * width + i for i in range(n - 1) if (r := rank.get(segment[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            best, left = divmod(heapq.heappop(heap), width)
            right = after[left]
            if piece[left] is None or right >= n or rank.get(joined := piece[left] + piece[right]) != best:
                continue
            piece[left], piece[right] = joined, None
            cost[left], cost[right] = 1, 0
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                if (r := rank.get(joined + piece[follow])) is not None:
                    heapq.heappush(heap, r * width + left)
            if (ahead := before[left]) >= 0 and (r := rank.get(piece[ahead] + joined)) is not None:
                heapq.heappush(heap, r * width + ahead)
        return sum(cost)

    def count(self, text: str) -> int:
        if not text:
            return 0
        lines = text.split("\n") if self.lines else [text]
        total = self.newline * (len(lines) - 1)
        if MARK in text or "  " in text or text[0] == " ":
            # Marks in a row belong to one segment with the word after them.
            lines[0] = MARK + lines[0]
            return total + sum(self.bare[s] for x in lines for s in re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", x.replace(" ", MARK)))
        for i, line in enumerate(lines):
            words = line.split(" ")
            if i:
                total += self.bare[words[0]]
                del words[0]
            elif not line:
                total += self.marked[""]
                continue
            total += sum(map(self.marked.__getitem__, words))
        return total


def counter(model: bytes) -> PieceCounter:
    """One counter for a worker process, so that later tasks profit from its memory."""
    return held(f"pieces-{hash(model)}", lambda: PieceCounter(model))


def token_counts(docs: DataFrame, model_path: str, limit: int = CONTEXT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, over its whole text.

    NULL texts are empty and have no tokens. Rows without a doc_id and repeated rows stay; other columns
    are ignored. ``model_path`` is read on the driver and its bytes go to the tasks.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    out = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(model.value).count
        tokens = [count(t) for t in b.column("text").to_pylist()]
        return record(out, b.column("doc_id"), b.column("n_bytes"), tokens, [t > limit for t in tokens])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return map_rows(rows, batch, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
