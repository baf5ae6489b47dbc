"""Mixing by soft membership: documents belong to each domain in part, and their rates make the mix.

A classifier fitted on a labelled table gives every document a probability for each domain. A document with
rate r counts r times. The expected tokens of a domain are the sum over documents of rate, tokens and
probability. Rates from 0 up, or to ``most`` if the caller sets a bound, are sought that bring these totals to the targets, by least
squares with a small pull towards 1:

    minimise  error' M error  +  pull * sum_d tokens_d / T * (rate_d - 1)^2,   error_k = (total_k - target_k) / T

with T the tokens of all documents. M weighs the domains by the inverse of their Gram matrix, so that a rare
domain's error counts as much as a common one's and the steps are few. Projected gradient steps with momentum
solve it. In each step Spark adds up the totals, a few numbers, and these are all a document needs for its
next rate. So tasks work their rates out anew from the list of steps so far, and no state is written between
steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACES, fresh_name, keyed_texts, map_rows, record, span_hashes, staged, stretches, text_or_empty

# Labelled documents the classifier is fitted on, at most; chosen by a hash of their doc_id.
TRAINED_ON = 20_000
# Its vocabulary: so many words at most, each in at least so many of these documents.
VOCABULARY, LEAST_DOCUMENTS = 20_000, 5
PULL, MOST = 0.01, float("inf")
# Steps end when twice no total moves by more than this part of all tokens. After so many there is a warning.
CLOSE, STEPS = 1e-4, 200
# A target counts as missed by more than this part of all tokens.
MISSED = 0.01


# Small letters, digits and all bytes of longer characters make words; other visible bytes make marks.
_KIND = np.full(256, 2, dtype=np.int8)
_KIND[list(SPACES)] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_SMALL = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words and of the runs of marks."""
    kind = np.concatenate(([0], _KIND[data], [0]))
    edge = np.flatnonzero(kind[1:] != kind[:-1])
    starts = edge[kind[edge + 1] != 0]
    return starts, edge[np.searchsorted(edge, starts) + 1]


def words(text: bytes) -> set[str]:
    """The different words and runs of marks of a text, A-Z as small letters."""
    text = text.translate(_SMALL)
    starts, ends = spans(np.frombuffer(text, dtype=np.uint8))
    return {text[a:b].decode(errors="replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)}


def hashes(text: bytes) -> np.ndarray:
    """A hash for each word and run of marks, in order."""
    found = [span_hashes(d, *spans(d)) for d in stretches(text.translate(_SMALL))]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


@dataclass
class Classifier:
    """Weights of the words that count, by sorted hash, and a bias; a column for each domain."""

    keys: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        kinds = np.unique(found)
        score = self.bias
        if len(kinds) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, kinds), len(self.keys) - 1)
            score = score + self.weights[at[self.keys[at] == kinds]].sum(axis=0)
        p = np.exp(score - score.max())
        return p / p.sum()


def classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], trained_on: int = TRAINED_ON) -> Classifier:
    """Fitted on ``labelled`` (doc_id, domain) and the documents' words.

    Labels without a doc_id, without a domain or of an unknown one are left out, as are those of documents that
    are not in ``docs``. Of several labels of a document the first domain counts, of several rows with its doc_id the
    least text. A domain without labels has the probability 0; without any usable label, or with only one that
    counts, all are equally likely or that one is certain, and the former is warned of.
    """
    place = F.array_position(F.array(*(F.lit(d) for d in domains)), F.col("domain"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    labels = (
        labelled.select(F.col("doc_id").cast("long").alias("doc_id"), (place - 1).cast("double").alias("label"))
        .filter((F.col("label") >= 0) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        # Labels of documents that are not there take no place in the sample.
        .join(known, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(trained_on)
    )
    fields = [("doc_id", pa.int64()), ("label", pa.float64()), ("words", pa.list_(pa.string()))]

    def split(b: pa.RecordBatch) -> pa.RecordBatch:
        return record(fields, b.column("doc_id"), b.column("label"), [sorted(words(t)) for t in b.column("text").to_pylist()])

    # At most ``trained_on`` pairs of numbers are broadcast. Of rows with one doc_id the least text is taken.
    chosen = keyed_texts(docs).join(F.broadcast(labels), "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    sample = staged(map_rows(chosen.select("doc_id", "label", "text"), split, "doc_id long, label double, words array<string>"), "labelled")
    if sample.isEmpty():
        warnings.warn("no document has a label of the domains: every domain is taken to be as likely", MixWarning, stacklevel=3)
        return Classifier(np.zeros(0, np.uint64), np.zeros((0, len(domains))), np.zeros(len(domains)))
    least = min(LEAST_DOCUMENTS, sample.count())
    if sample.filter(F.size("words") > 0).isEmpty() or sample.select("label").distinct().count() < 2:
        # Nothing to tell domains apart by: their shares in the sample are all there is to know.
        n = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
        with np.errstate(divide="ignore"):
            bias = np.log(np.array([n.get(k, 0) for k in range(len(domains))], dtype=float))
        return Classifier(np.zeros(0, np.uint64), np.zeros((0, len(domains))), bias)
    counter = CountVectorizer(inputCol="words", outputCol="features", vocabSize=VOCABULARY, minDF=least, binary=True).fit(sample)
    model = LogisticRegression(family="multinomial", regParam=0.003, elasticNetParam=0.5, maxIter=60).fit(counter.transform(sample))
    keys = np.array([hashes(w.encode())[0] for w in counter.vocabulary], dtype=np.uint64)
    weights = np.zeros((len(keys), len(domains)))
    bias = np.full(len(domains), -np.inf)
    seen = model.numClasses
    weights[:, :seen], bias[:seen] = model.coefficientMatrix.toArray().T, model.interceptVector.toArray()
    rank = np.argsort(keys)
    return Classifier(keys[rank], weights[rank], bias)


def posteriors(docs: DataFrame, model: Classifier, domains: list[str]) -> DataFrame:
    """(doc_id, row, tokens, p): every row with its number of words and runs of marks, and a probability for each domain."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [("doc_id", pa.int64()), ("row", pa.int64()), ("tokens", pa.int64()), ("p", pa.list_(pa.float32()))]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [hashes(t) for t in b.column("text").to_pylist()]
        p = [shared.value.probabilities(f).astype(np.float32) for f in found]
        return record(fields, b.column("doc_id"), b.column("row"), [len(f) for f in found], p)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_or_empty().alias("text"))
    return map_rows(rows, batch, "doc_id long, row long, tokens long, p array<float>")


class MixWarning(UserWarning):
    """A mix that is not what was asked for."""


@dataclass(frozen=True)
class Share:
    """Expected tokens of a domain in the mix: what it should have, and what its rates give."""

    domain: str
    target: float
    reached: float


def warned(shares: list[Share], whole: float) -> None:
    """A warning that names each domain whose target is missed."""
    missed = [s for s in shares if abs(s.reached - s.target) > MISSED * whole]
    if missed:
        said = "; ".join(f"{s.domain}: {s.reached:.0f} of {s.target:.0f} expected tokens" for s in missed)
        warnings.warn(f"the mix misses its targets: {said}", MixWarning, stacklevel=3)


Steps = list[tuple[float, tuple[float, ...]]]


def followed(p: np.ndarray, steps: Steps, pull: float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps, and the point from which the next one starts.

    Each step has its momentum and the domains' weighed errors, measured at the point it starts from.
    """
    rate = np.ones(len(p))
    point = rate
    for momentum, errors in steps:
        new = np.clip(point - (p @ np.array(errors) + pull * (point - 1)) / (1 + pull), 0, most)
        point = new + momentum * (new - rate)
        rate = new
    return rate, point


def probabilities(b: pa.RecordBatch, domains: int) -> np.ndarray:
    return b.column("p").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, domains)


def totals(scores: DataFrame, domains: int, steps: Steps, pull: float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the rates, and at the point of the next step."""

    def run(batches):
        sums = np.zeros((2, domains))
        for b in batches:
            p, tokens = probabilities(b, domains), b.column("tokens").to_numpy()
            for i, rate in enumerate(followed(p, steps, pull, most)):
                sums[i] += (rate * tokens) @ p
        yield record([("k", pa.int32()), ("at_rate", pa.float64()), ("at_point", pa.float64())], np.arange(domains), sums[0], sums[1])

    got = scores.select("tokens", "p").mapInArrow(run, "k int, at_rate double, at_point double")
    rows = {r["k"]: r for r in got.groupBy("k").agg(F.sum("at_rate").alias("at_rate"), F.sum("at_point").alias("at_point")).collect()}
    return tuple(np.array([rows[k][c] if k in rows else 0.0 for k in range(domains)]) for c in ("at_rate", "at_point"))


def metric(scores: DataFrame, domains: int, whole: float, pull: float) -> np.ndarray:
    """The weights M of the domains' errors: the inverse of their Gram matrix, a small matrix that Spark adds up."""

    def run(batches):
        sums = np.zeros((domains, domains))
        for b in batches:
            p = probabilities(b, domains)
            sums += p.T @ (p * b.column("tokens").to_numpy()[:, None])
        yield record([("k", pa.int32()), ("s", pa.float64())], np.arange(domains * domains), sums.ravel())

    got = scores.select("tokens", "p").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    gram = np.zeros(domains * domains)
    for r in got:
        gram[r["k"]] = r["s"]
    return np.linalg.inv(gram.reshape(domains, domains) / whole + pull * np.eye(domains))


def fitted_steps(scores: DataFrame, target: np.ndarray, whole: float, pull: float = PULL, most: float = MOST) -> Steps:
    """The steps that lead to the rates; ``target`` in tokens for each domain, ``whole`` the tokens of all documents."""
    steps: Steps = []
    weigh = metric(scores, len(target), whole, pull)
    pace, before, calm = 1.0, None, 0
    while len(steps) < STEPS and calm < 2:
        at_rate, at_point = totals(scores, len(target), steps, pull, most)
        if before is not None:
            calm = calm + 1 if np.abs(at_rate - before).max() <= CLOSE * whole else 0
            if objective(at_rate, target, weigh) > objective(before, target, weigh):
                pace = 1.0  # momentum has overshot
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        momentum = (pace - 1) / following if steps else 0.0
        steps.append((float(momentum), tuple((weigh @ (at_point - target) / whole).tolist())))
        pace, before = following, at_rate
    if calm < 2:
        warnings.warn(f"the rates still moved after {STEPS} steps", MixWarning, stacklevel=2)
    return steps


def objective(total: np.ndarray, target: np.ndarray, weigh: np.ndarray) -> float:
    return float((total - target) @ weigh @ (total - target))


def mixed(
    docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], tokens: float | None = None,
    pull: float = PULL, most: float = MOST, trained_on: int = TRAINED_ON, report: Callable[[list[Share], float], None] = warned,
) -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate, copies) for every row.

    ``weights`` maps each domain to its share, and ``tokens`` is what the mix should have in all (as many as
    the documents if not given). ``copies`` is the rate rounded up or down, by a hash of doc_id and row, so
    that it is right on average. NULL and empty texts have no tokens and take part with the classifier's
    prior. Rows without a doc_id and repeated rows have a rate each; other columns are ignored. An empty
    table gives no rows. ``report`` is given each domain's target and reached tokens, and the tokens of all
    documents; by default it warns of targets that the documents cannot meet.
    """
    domains = sorted(weights)
    if docs.isEmpty():
        model_rows = docs.sparkSession.createDataFrame([], "doc_id long, row long, tokens long, p array<float>")
        return rated(model_rows, domains, [], pull, most)
    fit = fitted_mix(docs, labelled, weights, tokens, pull, most, trained_on, report)
    return rated(fit.scores, domains, fit.steps, pull, most)


@dataclass
class Mix:
    """A fitted mix: the classifier, every row's posteriors as a stored table, and the steps that lead to its rate."""

    model: Classifier
    scores: DataFrame
    steps: Steps
    pull: float
    most: float


def fitted_mix(
    docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], tokens: float | None = None,
    pull: float = PULL, most: float = MOST, trained_on: int = TRAINED_ON, report: Callable[[list[Share], float], None] = warned,
) -> Mix:
    domains = sorted(weights)
    model = classifier(docs, labelled, domains, trained_on)
    scores = staged(posteriors(docs, model, domains), "posteriors")
    whole = float(scores.agg(F.sum("tokens")).first()[0] or 0) or 1.0
    share = np.array([weights[d] for d in domains], dtype=float)
    target = share / share.sum() * (whole if tokens is None else tokens)
    steps = fitted_steps(scores, target, whole, pull, most)
    reached, _ = totals(scores, len(domains), steps, pull, most)
    report([Share(*s) for s in zip(domains, target.tolist(), reached.tolist(), strict=True)], whole)
    return Mix(model, scores, steps, pull, most)


def tossed(doc_id: Column, row: Column) -> Column:
    """A number from 0 to 1 for a row, which rounds its rate up or down."""
    return (F.xxhash64(doc_id, row).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))).cast("double")


def rated(scores: DataFrame, domains: list[str], steps: Steps, pull: float, most: float) -> DataFrame:
    names = [f"p_{d}" for d in domains]
    fields = [("doc_id", pa.int64()), ("row", pa.int64()), ("tokens", pa.int64()), *((n, pa.float64()) for n in names), ("rate", pa.float64())]

    def run(batches):
        for b in batches:
            p = probabilities(b, len(domains))
            yield record(fields, b.column("doc_id"), b.column("row"), b.column("tokens"), *p.T, followed(p, steps, pull, most)[0])

    made = scores.mapInArrow(run, "doc_id long, row long, tokens long, " + ", ".join(f"{n} double" for n in names) + ", rate double")
    copies = F.floor(F.col("rate") + tossed(F.col("doc_id"), F.col("row"))).cast("long")
    return made.withColumn("copies", copies).select("doc_id", "row", "tokens", *names, "rate", "copies")


def drawn(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], **options) -> DataFrame:
    """The documents of the mix: each row as often as its copies in mixed() say, with the columns it has.

    A last pass works each row's rate out again and lets it through as many times, so nothing has to find a row again.
    The toss that rounds a rate is by doc_id and the row's place in that pass; a task that is run again tosses alike.
    """
    domains, columns, schema = sorted(weights), docs.columns, docs.schema
    if docs.isEmpty():
        return docs
    fit = fitted_mix(docs, labelled, weights, **options)
    shared = docs.sparkSession.sparkContext.broadcast(fit.model)
    steps, pull, most = fit.steps, fit.pull, fit.most

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, tosses = b.column(len(columns)).to_pylist(), b.column(len(columns) + 1).to_numpy()
        p = np.stack([shared.value.probabilities(hashes(t)) for t in texts]).astype(np.float32).astype(np.float64)
        rate = followed(p, steps, pull, most)[0]
        copies = np.floor(rate + tosses).astype(np.int64)
        return b.select(list(range(len(columns)))).take(pa.array(np.repeat(np.arange(len(copies)), copies)))

    whole, toss = fresh_name(columns, "whole_text"), fresh_name(columns, "toss")
    rows = docs.select(*columns, text_or_empty().alias(whole), tossed(F.col("doc_id").cast("long"), F.monotonically_increasing_id()).alias(toss))
    return map_rows(rows, batch, schema)


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from quality and toxic flags: toxic before poor before good; NULL flags say nothing."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))
