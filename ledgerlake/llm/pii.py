"""Personal data: exact patterns, and a skip-chain conditional random field that adds what they miss.

The patterns (e-mail, IP address, card, phone) give the base spans, which always stay. Words with a digit or
an at sign are the nodes of the field; all other words are taken to be ordinary and show up as features of
their neighbours. Neighbouring nodes are tied by a chain. Nodes of one document with the same text, or the
same shape, are tied by skip edges, so that a number told apart in one place is told apart in all: two by an
edge, more by an edge from each to a hub, a variable of their own, so that evidence goes two edges however
many they are. Loopy belief propagation passes messages along all edges, for all documents of a batch at
once, and in each document until its messages rest.

The field is fitted on the driver from a bounded sample of documents, whose labels the patterns give. A word
that has the look of a pattern but fails its test, such as a card number with a wrong check digit, has no
label there, so the field decides on it from what resembles it.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from dataclasses import field as dataclass_field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, record

KINDS = ("email", "ip", "card", "phone")
# Documents the field is fitted on, and the most characters of one.
SAMPLE, SAMPLE_CHARS = 2000, 20_000
# An added span's words have at least this probability.
LEAST = 0.8
FEATURES = 1 << 12
# A document's messages rest when none changes by more than CLOSE in a round. A new message keeps the part DAMPING of
# the old one. Messages that still swing after EASY rounds are brought to rest: from then on each round moves them by
# SLOWER of the part before.
CLOSE, DAMPING, EASY, SLOWER = 1e-4, 0.3, 200, 0.97

# The patterns. The e-mail is found from its at sign, and the address from the start of its
# digits, which gives the same matches in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
HINT = re.compile(r"[0-9@]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def is_byte(digits: str) -> bool:
    rest = digits.lstrip("0")
    return len(rest) <= 3 and int(rest or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def looks(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passed) of every match of a pattern; passed is false where its test fails."""
    for a, b in emails(text):
        yield "email", a, b, True
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        yield "ip", m.start(), m.end(), all(map(is_byte, m[0].split(".")))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) >= 12:
            yield "card", m.start(), m.end(), len(digits) <= 19 and luhn(digits)
    for m in PHONE.finditer(text):
        n = len(DIGIT.findall(m[0]))
        yield "phone", m.start(), m.end(), 9 <= n <= 15


def in_order(spans: Sequence[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start and then by kind; offsets in code points."""
    return in_order([(k, a, b) for k, a, b, passed in looks(text) if passed])


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@dataclass
class Nodes:
    """The field of some documents: features of each node, its words, and edges between nodes."""

    features: list[list[int]]
    spans: list[tuple[int, int, int]]  # document, start, end
    labels: list[int]  # 0 ordinary, 1.. a kind, -1 unknown
    chain: list[tuple[int, int]]
    same: list[tuple[int, int]]
    alike: list[tuple[int, int]]
    # Nodes tied to hubs, which are numbered on their own.
    same_hub: list[tuple[int, int]] = dataclass_field(default_factory=list)
    alike_hub: list[tuple[int, int]] = dataclass_field(default_factory=list)
    hubs: list[int] = dataclass_field(default_factory=list)  # document


def shape(word: str) -> str:
    return re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", word[:80]))


def described(word: str) -> list[str]:
    digits = sum(c in "0123456789" for c in word[:200])
    letters = sum(c.isalpha() for c in word[:200])
    bucket = next(i for i, top in enumerate((0, 2, 3, 4, 8, 11, 19, 10**9)) if digits <= top)
    found = [f"shape {shape(word)}", f"digits {bucket}", f"digits {bucket} letters {min(letters, 4)}", f"dots {min(word.count('.'), 4)} digits {bucket}"]
    return found + [f"has {c}" for c in "@+()=-\"'" if c in word]


def nodes(texts: Sequence[str]) -> Nodes:
    out = Nodes([], [], [], [], [], [])
    for document, text in enumerate(texts):
        if not HINT.search(text):
            continue
        marks = sorted(looks(text), key=lambda m: (not m[3], m[1]))
        covers: list[tuple[int, int, int]] = [(a, b, KINDS.index(k) + 1 if passed else -1) for k, a, b, passed in marks]
        kinds: dict[tuple[str, str], list[int]] = {}
        before, previous, waiting = "", -1, -1
        for m in WORD.finditer(text):
            word = m[0]
            if waiting >= 0:
                out.features[waiting].append(hashed(f"next {shape(word)}"))
                waiting = -1
            if HINT.search(word):
                node = len(out.spans)
                out.spans.append((document, *m.span()))
                out.features.append([hashed("bias"), *map(hashed, described(word)), hashed(f"before {before}")])
                out.labels.append(next((l for a, b, l in covers if a < m.end() and m.start() < b), 0) if covers else 0)
                if previous >= 0:
                    out.chain.append((previous, node))
                kinds.setdefault(("same", word.strip(".,;:!?\"'")), []).append(node)
                kinds.setdefault(("alike", shape(word)), []).append(node)
                previous = waiting = node
            else:
                previous = -1
            before = shape(word)
        for (tie, _), members in kinds.items():
            if len(members) == 2:
                (out.same if tie == "same" else out.alike).append((members[0], members[1]))
            elif len(members) > 2:
                (out.same_hub if tie == "same" else out.alike_hub).extend((node, len(out.hubs)) for node in members)
                out.hubs.append(document)
    return out


def in_pairs(pairs: list[tuple[int, int]], hubs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs, and each node of a hub with the next one."""
    last: dict[int, int] = {}
    found = list(pairs)
    for node, hub in hubs:
        if hub in last:
            found.append((last[hub], node))
        last[hub] = node
    return found


def hashed(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


@dataclass
class Field:
    """Weights: of features for each label, of label pairs along the chain, and for agreeing along skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray  # (same, alike) x labels


LABELS = len(KINDS) + 1


def flat(features: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(features)), [len(f) for f in features]), np.array([x for f in features for x in f], dtype=np.int64)


def fit(sample: Nodes, steps: int = 200, rate: float = 0.5, decay: float = 1e-4) -> Field:
    """Maximum pseudo-likelihood: each labelled node given its labelled neighbours."""
    field = Field(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((2, LABELS)))
    y = np.array(sample.labels, dtype=np.int64)
    if not len(y) or not (y > 0).any():
        field.unary[:, 0] = 1.0
        return field
    rows, columns = flat(sample.features)
    one = np.eye(LABELS)
    labelled = (y >= 0).astype(float)[:, None]
    target = np.where(labelled > 0, one[np.maximum(y, 0)], 0)
    ties = (sample.chain, in_pairs(sample.same, sample.same_hub), in_pairs(sample.alike, sample.alike_hub))
    known = [np.array([(a, b) for a, b in e if y[a] >= 0 and y[b] >= 0], dtype=np.int64).reshape(-1, 2) for e in ties]
    squares = [np.full(w.shape, 1e-6) for w in (field.unary, field.chain, field.skip)]
    for _ in range(steps):
        score = np.zeros((len(y), LABELS))
        np.add.at(score, rows, field.unary[columns])
        (a, b) = known[0].T
        np.add.at(score, b, field.chain[y[a]])
        np.add.at(score, a, field.chain[:, y[b]].T)
        for k in (0, 1):
            a, b = known[k + 1].T
            np.add.at(score, a, one[y[b]] * field.skip[k])
            np.add.at(score, b, one[y[a]] * field.skip[k])
        p = np.exp(score - score.max(axis=1, keepdims=True))
        miss = (target - p / p.sum(axis=1, keepdims=True)) * labelled
        unary, chain, skip = (np.zeros_like(w) for w in (field.unary, field.chain, field.skip))
        np.add.at(unary, columns, miss[rows])
        a, b = known[0].T
        np.add.at(chain, y[a], miss[b])
        np.add.at(chain.T, y[b], miss[a])
        for k in (0, 1):
            a, b = known[k + 1].T
            skip[k] = (one[y[b]] * miss[a] + one[y[a]] * miss[b]).sum(axis=0)
        for w, g, s in zip((field.unary, field.chain, field.skip), (unary, chain, skip), squares, strict=True):
            g /= len(y)
            g -= decay * w
            s += g * g
            w += rate * g / np.sqrt(s)
    np.maximum(field.skip, 0, out=field.skip)
    return field


def to_hub(skip: np.ndarray) -> np.ndarray:
    """Weights of an edge to a hub: through the hub, two nodes are tied just as by an edge of the weights ``skip``.

    That is the logarithm of the square root of the edge's matrix, which is all ones and more on the diagonal;
    its root has positive entries.
    """
    value, vector = np.linalg.eigh(np.exp(np.diag(skip)))
    root = (vector * np.sqrt(np.maximum(value, 0))) @ vector.T
    return np.log(np.maximum(root, 1e-9))


def marginals(field: Field, found: Nodes) -> np.ndarray:
    """Probabilities of each node's labels when the messages along chain, skip and hub edges rest.

    A document's messages do not depend on the others of the batch.
    """
    n = len(found.spans)
    rows, columns = flat(found.features)
    unary = np.zeros((n + len(found.hubs), LABELS))
    np.add.at(unary, rows, field.unary[columns])
    hubs = [[(a, n + h) for a, h in edges] for edges in (found.same_hub, found.alike_hub)]
    kinds = [(found.chain, field.chain), (found.same, np.diag(field.skip[0])), (found.alike, np.diag(field.skip[1]))]
    kinds += [(edges, to_hub(field.skip[k])) for k, edges in enumerate(hubs)]
    ends = np.array([e for edges, _ in kinds for e in edges], dtype=np.int64).reshape(-1, 2)
    if len(ends):
        document = np.array([d for d, _, _ in found.spans], dtype=np.int64)[ends[:, 0]]
        kind = np.repeat(np.arange(len(kinds)), [len(edges) for edges, _ in kinds])
        weights = np.stack([w for _, w in kinds])
        message = np.zeros((2, len(ends), LABELS))  # each edge both ways
        moving = np.arange(len(ends))
        step = 1 - DAMPING
        for past in itertools.count():
            a, b = ends[moving].T
            old = message[:, moving]
            pair = weights[kind[moving]]
            belief = unary.copy()
            np.add.at(belief, b, old[0])
            np.add.at(belief, a, old[1])
            new = np.stack(
                (
                    np.logaddexp.reduce((belief[a] - old[1])[:, :, None] + pair, axis=1),
                    np.logaddexp.reduce((belief[b] - old[0])[:, :, None] + pair.transpose(0, 2, 1), axis=1),
                )
            )
            part = step * SLOWER ** max(0, past - EASY)
            change = part * (new - new.max(axis=2, keepdims=True) - old)
            message[:, moving] = old + change
            most = np.zeros(int(document.max()) + 1)
            np.maximum.at(most, document[moving], np.abs(change).max(axis=(0, 2)))
            moving = moving[most[document[moving]] > CLOSE]
            if not len(moving):
                break
        np.add.at(unary, ends[:, 1], message[0])
        np.add.at(unary, ends[:, 0], message[1])
    unary = unary[:n]
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


LEAD, TRAIL = re.compile(r"^[^A-Za-z0-9+(@]+"), re.compile(r"[^A-Za-z0-9)]+$")


def added_spans(field: Field, texts: Sequence[str], base: Sequence[Sequence[Span]]) -> list[list[Span]]:
    """For each text the spans that the field adds, which touch no base span."""
    found = nodes(texts)
    out: list[list[Span]] = [[] for _ in texts]
    if not found.spans:
        return out
    p = marginals(field, found)
    label = np.where(p[:, 1:].max(axis=1) >= LEAST, p[:, 1:].argmax(axis=1) + 1, 0)
    linked = set(found.chain)
    runs: list[list[int]] = []
    for node in np.flatnonzero(label).tolist():
        if runs and (runs[-1][-1], node) in linked and label[node] == label[runs[-1][-1]] and KINDS[label[node] - 1] == "phone":
            runs[-1].append(node)
        else:
            runs.append([node])
    for run in runs:
        document, start, _ = found.spans[run[0]]
        end = found.spans[run[-1]][2]
        text = texts[document][start:end]
        core = TRAIL.sub("", LEAD.sub("", text))
        start += text.find(core)
        end = start + len(core)
        if core and all(b <= start or end <= a for _, a, b in base[document]):
            out[document].append((KINDS[label[run[0]] - 1], start, end))
    return out


def fitted(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Field:
    """The field of a sample of documents with a digit or an at sign: those with the smallest hashes of doc_id and text.

    Hashes alone are sorted; the driver gets at most ``sample`` texts of at most ``sample_chars`` characters.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("h"), F.col("text").cast("string").alias("text")).filter(
        F.col("text").rlike("[0-9@]") & (F.length("text") <= sample_chars)
    )
    last = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return fit(nodes([]))
    chosen = rows.filter(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect()
    return fit(nodes([r["text"] for r in chosen]))


def spans_of(field: Field, texts: Sequence[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    return [(b, in_order([*b, *a])) for b, a in zip(base, added_spans(field, texts, base), strict=True)]


TEXTS_AT_ONCE = 256


def batches_of(texts: list[str]) -> Iterator[list[str]]:
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        yield texts[at : at + TEXTS_AT_ONCE]


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row, over its whole text.

    The counts and the digest are those of the base spans. NULL texts are empty and have no spans. Rows
    without a doc_id and repeated rows stay; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(field or fitted(docs))
    out = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for texts in batches_of(b.column("text").to_pylist()):
            for base, every in spans_of(model.value, texts):
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                made.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
        return record(out, b.column("doc_id"), *zip(*made, strict=True))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_rows(rows, batch, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the first one's kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join((*out, text[at:]))


def redacted(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The documents with personal data masked and ``n_chars``, where there is one, counted again; NULL texts stay NULL."""
    model = docs.sparkSession.sparkContext.broadcast(field or fitted(docs))
    place = docs.columns.index("text")

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(place).to_pylist()
        clean: list[str | None] = []
        for some in batches_of(texts):
            for text, (_, every) in zip(some, spans_of(model.value, [t or "" for t in some]), strict=True):
                clean.append(None if text is None else masked(text, every))
        columns = [pa.array(clean, pa.string()) if i == place else c for i, c in enumerate(b.columns)]
        return pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    changed = map_rows(docs.withColumn("text", F.col("text").cast("string")), batch, docs.schema)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed
