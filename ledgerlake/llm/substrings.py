"""Substring deduplication: words that a repeated passage covers are removed from all documents but the first.

A word goes if a window of ``length`` words that covers it also occurs in a document with a smaller doc_id.
Suffix automata decide it. An automaton of reference passages knows, for each of its states, the smallest
doc_id the state's words occur in; documents' passages are streamed through it, and wherever the match is
``length`` words or longer, the state that stands for the last ``length`` words tells the first owner.

Only passages that can match meet. Every window has an anchor, the smallest hash among its runs of ``grain``
words, so equal windows have equal anchors. Anchors that occur in one document are dropped in two exchanges
of sorted hashes. The rest routes passages: a passage goes to the reference shard of its anchor. Equal
passages are merged on the way. An anchor in more than ``common`` documents, such as a line that is printed
everywhere, would make one large shard; its windows travel one by one, by the hash of the window.

A document with the very text of an earlier one loses all its windows at once, without a passage.

Automata are not broadcast, as all of them together grow with the corpus; each shard's is built where its
passages meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import parts, record, staged, taken_over, text_or_empty, window_hashes, word_hashes
from ledgerlake.operators.joins import left_join_spread

LENGTH, GRAIN = 13, 10
# Documents an anchor may have before its windows travel one by one.
COMMON = 1000
# A row without a doc_id stands behind all others.
LAST = np.iinfo(np.int64).max
# Anchors of documents that a task gathers before it sends them, and bits of a hash that are sent.
GATHERED, BITS = 2_000_000, 48
LEAST_RANGES = 12


def anchors(words: np.ndarray, length: int, grain: int) -> np.ndarray:
    """The anchor of each window of a text."""
    grains = window_hashes(words, grain)
    count = max(0, len(words) - length + 1)
    least = grains[:count].copy()
    for i in range(1, length - grain + 1):
        np.minimum(least, grains[i : i + count], out=least)
    return least >> np.uint64(64 - BITS)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, no wider than the largest needs; the first byte tells the width."""
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplaned(data: bytes, n: int, at: int = 0) -> tuple[np.ndarray, int]:
    """n numbers that planes() wrote at a place, and the place after them."""
    width = data[at]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8, count=n * width, offset=at + 1).reshape(width, n).T
    return out.view("<u8").ravel(), at + 1 + n * width


def steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.zeros(1, ascending.dtype))


def gathered(batches, length: int, grain: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(anchor, key) pairs of many documents at a time, each pair once, in order."""
    taken_over("gathered")
    found: list[np.ndarray] = []
    keys: list[np.ndarray] = []
    size = 0
    for b in batches:
        for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
            own = np.unique(anchors(word_hashes(text), length, grain))
            found.append(own)
            keys.append(np.full(len(own), key, dtype=np.int64))
            size += len(own)
            if size >= GATHERED:
                yield ordered(found, keys)
                found, keys, size = [], [], 0
    if size:
        yield ordered(found, keys)


def ordered(found: list[np.ndarray], keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    anchor, key = np.concatenate(found), np.concatenate(keys)
    rank = np.lexsort((key, anchor))
    return anchor[rank], key[rank]


def slices(anchor: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The stretch of sorted anchors in each range of hashes."""
    shard = (anchor >> np.uint64(BITS - 24)) * np.uint64(ranges) >> np.uint64(24)
    edge = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.zeros(0, int)
    for a, b in zip(edge, np.append(edge[1:], len(shard)), strict=True):
        yield int(shard[a]), slice(int(a), int(b))


def repeated_anchors(rows: DataFrame, ranges: int, length: int, grain: int, common: int) -> DataFrame:
    """(shard, anchors): by range of hashes, the anchors of two documents or more, with a last bit for common ones."""

    def send(batches):
        for anchor, _ in gathered(batches, length, grain):
            kinds, count = np.unique(anchor, return_counts=True)
            for shard, part in slices(kinds, ranges):
                n = part.stop - part.start
                body = n.to_bytes(4, "little") + planes(steps(kinds[part])) + planes(count[part])
                yield record([("shard", pa.int32()), ("body", pa.binary())], [shard], [body])

    def merge(batches):
        """One range at a time, its anchors added up list by list."""
        taken_over("repeated_anchors")
        at, anchor, count = None, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

        def finished():
            kept = anchor[count > 1] << np.uint64(1) | (count[count > 1] > common).astype(np.uint64)
            if len(kept):
                body = len(kept).to_bytes(4, "little") + planes(steps(kept))
                yield record([("shard", pa.int32()), ("anchors", pa.binary())], [at], [body])

        for b in batches:
            shards, bodies = b.column("shard"), b.column("body")
            for i in range(b.num_rows):
                shard, body = shards[i].as_py(), bodies[i].as_py()
                if shard != at:
                    yield from finished()
                    at, anchor, count = shard, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
                n = int.from_bytes(body[:4], "little")
                step, place = unplaned(body, n, 4)
                anchor, count = added(anchor, count, np.cumsum(step, dtype=np.uint64), unplaned(body, n, place)[0])
        yield from finished()

    sent = rows.mapInArrow(send, "shard int, body binary")
    return sent.repartition(ranges, "shard").sortWithinPartitions("shard").mapInArrow(merge, "shard int, anchors binary")


def added(anchor: np.ndarray, count: np.ndarray, more: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted anchors and their counts after another sorted list."""
    anchor, count = np.concatenate((anchor, more)), np.concatenate((count, times))
    rank = np.argsort(anchor, kind="stable")
    anchor, count = anchor[rank], count[rank]
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.zeros(0, int)
    return anchor[first], np.add.reduceat(count, first) if len(first) else count


def own_repeats(rows: DataFrame, repeats: DataFrame, ranges: int, length: int, grain: int) -> DataFrame:
    """(key, anchors): for each key the lists of its anchors that repeat."""

    def send(batches):
        for anchor, key in gathered(batches, length, grain):
            for shard, part in slices(anchor, ranges):
                kinds, count = np.unique(anchor[part], return_counts=True)
                keys, place = np.unique(key[part], return_inverse=True)
                body = b"".join(
                    (len(kinds).to_bytes(4, "little"), len(keys).to_bytes(4, "little"), int(keys[0]).to_bytes(8, "little", signed=True),
                     planes(steps(kinds)), planes(count), planes(np.diff(keys, prepend=keys[0]).view(np.uint64)), planes(place))
                )
                yield record([("shard", pa.int32()), ("body", pa.binary())], [shard], [body])

    fields = [("key", pa.int64()), ("anchors", pa.binary())]

    def meet(batches):
        """A range's anchors come first, then the lists that are compared with them, one at a time."""
        taken_over("own_repeats")
        open_shard, repeats = None, np.zeros(0, np.uint64)
        for b in batches:
            shards, bodies, first = b.column("shard"), b.column("body"), b.column("first").to_pylist()
            for i in range(b.num_rows):
                shard, body = shards[i].as_py(), bodies[i].as_py()
                if first[i]:
                    open_shard, repeats = shard, np.cumsum(unplaned(body, int.from_bytes(body[:4], "little"), 4)[0], dtype=np.uint64)
                    continue
                if shard != open_shard:  # no anchor of the range repeats
                    continue
                n, m, base = int.from_bytes(body[:4], "little"), int.from_bytes(body[4:8], "little"), int.from_bytes(body[8:16], "little", signed=True)
                step, at = unplaned(body, n, 16)
                count, at = unplaned(body, n, at)
                gaps, at = unplaned(body, m, at)
                place, _ = unplaned(body, int(count.sum()), at)
                kinds = np.cumsum(step, dtype=np.uint64)
                found = np.minimum(np.searchsorted(repeats >> np.uint64(1), kinds), len(repeats) - 1)
                hit = np.repeat(repeats[found] >> np.uint64(1) == kinds, count.astype(np.int64))
                if not hit.any():
                    continue
                anchor, place = np.repeat(repeats[found], count.astype(np.int64))[hit], place[hit]
                rank = np.argsort(place, kind="stable")
                anchor, place = anchor[rank], place[rank]
                edge = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                keys = np.int64(base) + np.cumsum(gaps.view(np.int64))
                yield record(fields, keys[place[edge].astype(np.int64)], [x.tobytes() for x in np.split(anchor, edge[1:])])

    sent = rows.mapInArrow(send, "shard int, body binary").withColumn("first", F.lit(False))
    known = repeats.select("shard", F.col("anchors").alias("body"), F.lit(True).alias("first"))
    together = known.unionByName(sent).repartition(ranges, "shard").sortWithinPartitions("shard", F.col("first").desc())
    return together.mapInArrow(meet, "key long, anchors binary")


def passages(words: list[bytes], repeats: np.ndarray, length: int, grain: int) -> Iterator[tuple[int, int, int]]:
    """(route, start, end) of the passages of a text, in words, whose windows may repeat.

    Windows in a row with the same anchor make one passage; those of a common anchor are passages by themselves.
    """
    hashes = word_hashes(b" ".join(words))
    anchor = anchors(hashes, length, grain)
    if not len(anchor):
        return
    found = np.minimum(np.searchsorted(repeats >> np.uint64(1), anchor), len(repeats) - 1)
    hit = repeats[found] >> np.uint64(1) == anchor
    common = hit & (repeats[found] & np.uint64(1)).astype(bool)
    edge = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(anchor)], strict=True):
        if hit[a] and not common[a]:
            yield int(anchor[a]), a, b + length - 1
    windows = window_hashes(hashes, length).view(np.int64)
    for i in np.flatnonzero(common).tolist():
        yield int(windows[i]), i, i + length


class Automaton:
    """A suffix automaton of word sequences; each state has the smallest document its words occur in."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.first = [-1], [0], [LAST]

    def state(self, size: int, link: int, after: dict[bytes, int], first: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.size.append(size)
        self.first.append(first)
        return len(self.size) - 1

    def split(self, p: int, word: bytes, q: int) -> int:
        """The state for p's words and one more, parted from a longer q where need be."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self.state(self.size[p] + 1, self.link[q], dict(self.next[q]), LAST)
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list[bytes], document: int) -> None:
        last = 0
        for word in words:
            if (q := self.next[last].get(word)) is not None:
                last = self.split(last, word, q)
            else:
                p, new = last, self.state(self.size[last] + 1, 0, {}, LAST)
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self.split(p, word, self.next[p][word])
                last = new
            self.first[last] = min(self.first[last], document)

    def finish(self) -> None:
        """Words occur wherever longer ones that end in them do."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.first[self.link[s]] = min(self.first[self.link[s]], self.first[s])

    def owners(self, words: list[bytes], length: int) -> list[int]:
        """For each window of ``length`` words the first document that has it; LAST where none does."""
        out, s, match = [], 0, 0
        for i, word in enumerate(words):
            while s and word not in self.next[s]:
                s = self.link[s]
                match = self.size[s]
            s = self.next[s].get(word, 0)
            match = match + 1 if s else 0
            while s and self.size[self.link[s]] >= length:
                s = self.link[s]
                match = self.size[s]
            if i >= length - 1:
                out.append(self.first[s] if match >= length else LAST)
        return out


def judged(distinct: DataFrame, shards: int, length: int) -> DataFrame:
    """(route, name, owners): for each passage the first document of each of its windows."""
    fields = [("route", pa.int64()), ("name", pa.int64()), ("owners", pa.binary())]

    def close(route: int, group: list[tuple[int, bytes, int]], out: list[tuple]) -> None:
        if len(group) == 1:
            # One passage alone owns its windows.
            name, text, document = group[0]
            out.append((route, name, np.full(text.count(b" ") + 2 - length, document, dtype=np.int64).tobytes()))
            return
        automaton = Automaton()
        split = [(name, text.split(b" "), document) for name, text, document in group]
        for _, words, document in split:
            automaton.add(words, document)
        automaton.finish()
        out.extend((route, name, np.array(automaton.owners(words, length), dtype=np.int64).tobytes()) for name, words, _ in split)

    def run(batches):
        route, group = None, []
        for b in batches:
            out: list[tuple] = []
            for r, name, text, document in zip(*(b.column(c).to_pylist() for c in ("route", "name", "passage", "document")), strict=True):
                if r != route and group:
                    close(route, group, out)
                    group = []
                route = r
                group.append((name, text, document))
            if out:
                yield record(fields, *zip(*out, strict=True))
        if group:
            out = []
            close(route, group, out)
            yield record(fields, *zip(*out, strict=True))

    return distinct.repartition(shards, "route").sortWithinPartitions("route").mapInArrow(run, "route long, name long, owners binary")


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def later_copies(rows: DataFrame) -> DataFrame:
    """(key, copied): rows whose whole text a document with a smaller doc_id has, and the digest of the text."""
    light = rows.select("key", F.coalesce("doc_id", F.lit(LAST)).alias("document"), F.md5("text").alias("copied"))
    first = light.groupBy("copied").agg(F.min("document").alias("first"))
    return left_join_spread(light, first, "copied", ["first"]).filter("first < document").groupBy("key").agg(F.min("copied").alias("copied"))


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def deduplicated(docs: DataFrame, length: int = LENGTH, grain: int = GRAIN, common: int = COMMON) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row.

    NULL and empty texts have no words. Repeated rows and rows with the same doc_id stay and don't remove
    words from each other. A row without a doc_id counts as behind all others; such rows don't remove words
    from each other either. Other columns are ignored.
    """
    if not 0 < grain <= length:
        raise ValueError("grain must be between 1 and length")
    shards = parts(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    # Rows go by a hash of doc_id and text here; rows that share one only share candidates.
    rows = docs.select(F.xxhash64(doc_id, F.col("text").cast("string")).alias("key"), doc_id.alias("doc_id"), text_or_empty().alias("text"))
    light = rows.select("key", "text")
    # Ranges of anchors hold hashes alone, so fewer than the partitions do, and documents get fewer lists.
    ranges = max(LEAST_RANGES, shards // 4)
    repeats = staged(repeated_anchors(light, ranges, length, grain, common), "repeated-anchors", free=True)
    lists = own_repeats(light, repeats, ranges, length, grain).groupBy("key").agg(F.collect_list("anchors").alias("anchors"))
    lists = lists.join(later_copies(rows), "key", "full")

    def sort_out(batches):
        fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.binary()), ("anchors", pa.binary())]
        for b in batches:
            made = []
            for doc_id, text, lists, copied in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "anchors", "copied")), strict=True):
                words = text.split()
                if copied and len(words) >= length and hashlib.md5(text).hexdigest() == copied:
                    made.append((doc_id, len(words), len(words), digest([]), None, None))
                elif lists and len(words) >= length:
                    repeats = np.unique(np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in lists]))
                    made.append((doc_id, len(words), None, None, b" ".join(words), repeats.tobytes()))
                else:
                    made.append((doc_id, len(words), 0, digest(words), None, None))
            if made:
                yield record(fields, *zip(*made, strict=True))

    sorted_out = rows.join(lists, "key", "left").select("doc_id", "text", "anchors", "copied")
    # Numbered as it is written, and read from there: however it is cut into tasks later, a row keeps its number.
    numbered = sorted_out.mapInArrow(sort_out, f"{RESULT}, text binary, anchors binary").withColumn("row", F.monotonically_increasing_id())
    table = staged(numbered, "with-repeats", free=True)
    clear = table.filter(F.col("text").isNull()).select("doc_id", "n_words", "n_removed", "kept_sha256")
    open_rows = table.filter(F.col("text").isNotNull())

    def cut(batches):
        fields = [("row", pa.int64()), ("document", pa.int64()), ("start", pa.int64()), ("route", pa.int64()), ("passage", pa.binary())]
        for b in batches:
            for row, doc_id, text, repeats in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text", "anchors")), strict=True):
                words = text.split(b" ")
                found = list(passages(words, np.frombuffer(repeats, dtype=np.uint64), length, grain))
                if found:
                    document = LAST if doc_id is None else doc_id
                    made = [(row, document, a, route, b" ".join(words[a:z])) for route, a, z in found]
                    yield record(fields, *zip(*made, strict=True))

    cuts = open_rows.mapInArrow(cut, "row long, document long, start long, route long, passage binary").withColumn("name", F.xxhash64("passage"))
    cuts = staged(cuts, "passages", free=True)  # used twice
    distinct = cuts.groupBy("route", "name", "passage").agg(F.min("document").alias("document"))
    # Written, so that passages don't lie in the shuffles of two steps at once.
    distinct = staged(distinct, "distinct-passages", free=True)
    verdicts = staged(judged(distinct, shards, length), "verdicts", free=True)
    # The verdicts meet the places by route and name; Spark splits a hot one.
    removed = (
        cuts.select("row", "document", "start", "route", "name").hint("merge").join(verdicts, ["route", "name"])
        .select("row", "document", "start", "owners").mapInArrow(lambda batches: starts(batches, length), "row long, spans binary")
        .groupBy("row").agg(F.collect_list("spans").alias("spans"))
    )
    # Written, so that the shuffles of passages are gone when the texts move.
    removed = staged(removed, "removed", free=True)

    def finish(batches):
        fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        for b in batches:
            made = []
            for doc_id, text, spans in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                words = text.split(b" ")
                change = np.zeros(len(words) + 1, dtype=np.int64)
                for x in spans or ():
                    np.add.at(change, np.frombuffer(x, dtype=np.int64), 1)
                    np.add.at(change, np.frombuffer(x, dtype=np.int64) + length, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                made.append((doc_id, len(words), len(words) - len(kept), digest(kept)))
            if made:
                yield record(fields, *zip(*made, strict=True))

    finished = open_rows.select("row", "doc_id", "text").join(removed, "row", "left").select("doc_id", "text", "spans").mapInArrow(finish, RESULT)
    return clear.unionByName(finished)


def starts(batches, length: int):
    """(row, spans): the starts of windows that an earlier document has."""
    fields = [("row", pa.int64()), ("spans", pa.binary())]
    for b in batches:
        made = []
        for row, document, start, owners in zip(*(b.column(c).to_pylist() for c in ("row", "document", "start", "owners")), strict=True):
            found = np.flatnonzero(np.frombuffer(owners, dtype=np.int64) < document)
            if len(found):
                made.append((row, (found + start).astype(np.int64).tobytes()))
        if made:
            yield record(fields, *zip(*made, strict=True))
