"""Source divergence audit: how far the term frequencies of the sources of a language lie apart.

Every source gives each of the V terms of its language a smoothed share p of 10^9 parts. Two sources differ by the
sum over all terms of f(p, q) = (p - q)^2 / (p + q), rounded down for each term. Most terms are absent from most
sources, and an absent term has the same p0 everywhere in a source, so

    sum f(p, q) = V f(p0, q0)  +  terms of the one  +  terms of the other  +  terms of both,

where the terms of one source add f(p, q0) - f(p0, q0), and a term of both adds what is then still missing.

The terms of both come from a frequent-pattern tree. A term's row lists its sources, those with few words first, and
its share in each; equal rows are one row with a multiplicity. Rows in order are the tree in depth-first order:
the places that a row has in common with the row before it are nodes that exist already. Each node adds, once for each
of its ancestors, the correction of that pair of sources times the rows below the node. The tree is cut into ranges
of rows; a path that is cut counts in both parts with the rows that each has, so the sums stay exact.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import parts, record, staged, stretches

LEAST_DOCUMENTS, TOP = 10, 10
SCALE, SMOOTHING = 1_000_000_000, 2
# Terms a task counts before it sends them, and places of rows that are compared at once.
GATHERED, CELLS = 200_000, 1 << 21

# Letters a-z and all bytes of longer characters make terms, A-Z as small letters; all others part them.
_TERMS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

COUNTS = "lang string, source string, term string, n long, documents long"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): occurrences, and documents with the term; a NULL term counts the documents."""
    fields = [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("documents", pa.int64())]

    def sent(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (said, held, documents) in counts.items():
            terms = pa.array([None, *said], pa.binary()).cast(pa.string())
            size = len(terms)
            yield record(fields, [lang] * size, [source] * size, terms, [0, *said.values()], [documents, *map(held.__getitem__, said)])

    def run(batches):
        counts: dict[tuple[str, str], list] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                own = counts.setdefault((lang, source), [Counter(), Counter(), 0])
                size -= len(own[0])
                kinds: set[bytes] = set()
                for stretch in stretches(text.translate(_TERMS)):
                    terms = stretch.tobytes().split()
                    own[0].update(terms)
                    kinds.update(terms)
                own[1].update(kinds)
                own[2] += 1
                size += len(own[0])
                if size > GATHERED:
                    yield from sent(counts)
                    counts, size = {}, 0
        yield from sent(counts)

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*plain[:2], plain[2].cast("binary").alias("text"))
    return rows.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(n: str, total: str) -> Column:
    """p of a term with so many of a total of words; the product needs more than 63 bits for large counts."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + {SMOOTHING} AS DECIMAL(20,0))) div CAST(greatest({total} + {SMOOTHING} * v, 1) AS DECIMAL(20,0))"
    )


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def blocks(batches) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(lang, multiplicities, lengths, places, p, p0): rows of one language, the last three padded to the longest."""
    for b in batches:
        items = b.column("items")
        flat = items.flatten()
        columns = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
        ends = np.cumsum(items.value_lengths().to_numpy(zero_copy_only=False))
        lang, m = np.array(b.column("lang").to_pylist(), dtype=object), b.column("m").to_numpy()
        lengths = np.diff(ends, prepend=0)
        at = 0
        while at < len(m):
            # Rows of one language, so many that the padded block stays bounded.
            same = int(np.argmax(lang[at:] != lang[at])) or len(m) - at
            widest = np.maximum.accumulate(lengths[at : at + same]) * np.arange(1, same + 1)
            size = max(1, int(np.searchsorted(widest, CELLS, side="right")))
            own, first = lengths[at : at + size], ends[at] - lengths[at]
            filled = np.arange(own.max()) < own[:, None]
            padded = []
            for c in columns:
                out = np.full(filled.shape, -1, dtype=np.int64)
                out[filled] = c[first : first + own.sum()]
                padded.append(out)
            yield lang[at], m[at : at + size], own, *padded
            at += size


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first)


def corrections(m: np.ndarray, lengths: np.ndarray, place: np.ndarray, p: np.ndarray, p0: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, value): for pairs of places the sum over the tree's node-ancestor combinations. Rows are in order."""
    same = (place[1:] == place[:-1]) & (p[1:] == p[:-1])
    common = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    common = np.concatenate(([0], np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))))
    wide = np.int64(place.max() + 1)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for j in range(1, place.shape[1]):
        # A run of rows that share their first j + 1 places is a node; its rows are those below it.
        starts = np.flatnonzero(common <= j)
        below = np.add.reduceat(m, starts)
        real = lengths[starts] > j
        node, below = starts[real], below[real]
        pb, qb = p[node, j][:, None], p0[node, j][:, None]
        pa_, qa = p[node, :j], p0[node, :j]
        value = gaps(pa_, pb) - gaps(pa_, qb) - gaps(qa, pb) + gaps(qa, qb)
        found.append(summed((place[node, :j] * wide + place[node, j][:, None]).ravel(), (value * below[:, None]).ravel()))
    keys, values = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(keys):
        keys, values = summed(keys, values)
    return keys // wide, keys % wide, values


def both_terms(terms: DataFrame, partitions: int) -> DataFrame:
    """(lang, a, b, value): the corrections of terms that both sources have, by the sources' places, a before b."""
    fields = [("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())]
    # A row is as long as a language has sources.
    rows = terms.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "p", "p0"))).alias("items"))
    lists = rows.filter(F.size("items") > 1).groupBy("lang", "items").agg(F.count("*").alias("m"))

    def run(batches):
        for lang, *block in blocks(batches):
            a, b, value = corrections(*block)
            if len(a):
                yield record(fields, [lang] * len(a), a, b, value)

    ordered = lists.repartitionByRange(partitions, "lang", "items").sortWithinPartitions("lang", "items")
    return ordered.mapInArrow(run, "lang string, a long, b long, value long")


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audited(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for the other sources, ``term`` rows for the ``top`` terms.

    Terms are runs of letters and of characters beyond ASCII, A-Z as small letters, that ``least`` documents of the
    language have. NULL texts, languages and sources are empty strings, and groups like any other. Repeated rows
    count each; equal values rank by item. A language without terms has pairs of value 0; an empty table has no
    rows. A text may be of any length, its different terms are held at once. Other columns are ignored.
    """
    counts = staged(term_counts(docs), "term-counts")
    every = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("documents").alias("documents"))
    kept = staged(every.filter(F.col("documents") >= least).drop("documents"), "kept-terms")
    own = staged(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole"), "kept-counts")

    # One row for each group: its words, its language's words and terms, its place, and p of absent terms.
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    languages = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("all_total"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.fillna(0, ["total", "v", "all_total"])
    place = F.row_number().over(W.partitionBy("lang").orderBy("total", "source")).cast("long")
    groups = staged(groups.withColumns({"place": place, "p0": share("0", "total")}), "groups")

    terms = own.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total"), "q": share("whole", "all_total")})
    by_term = ranked(terms.filter("p > q").select("lang", "source", F.col("term").alias("item"), gap("p", "q").alias("value")), "term")

    one = groups.select("lang", "source", F.col("place").alias("a"), F.col("p0").alias("pa"), "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("p0").alias("pb"))
    # As many rows as the pairs that are returned.
    pairs = staged(one.join(other, "lang").filter("a <> b"), "pairs")
    singles = terms.groupBy("lang", F.col("place").alias("a"), "p").agg(F.count("*").alias("m"))
    single = singles.join(pairs.select("lang", "a", "b", "pa", "pb"), ["lang", "a"]).withColumn("value", F.col("m") * (gap("p", "pb") - gap("pa", "pb")))
    sums = single.select("lang", "a", "b", "value").unionByName(both_terms(terms, parts(docs.sparkSession)))
    sums = sums.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("more"))
    both_ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    more = sums.select("lang", "more", both_ways.alias("x")).select("lang", "x.a", "x.b", "more")
    whole = F.col("v") * gap("pa", "pb") + F.coalesce("more", F.lit(0))
    by_pair = ranked(pairs.join(more, ["lang", "a", "b"], "left").select("lang", "source", "item", whole.alias("value")), "pair")
    return by_pair.unionByName(by_term.filter(F.col("rank") <= top))


def oracle(least: int = LEAST_DOCUMENTS, top: int = TOP) -> str:
    """The SQL for audited()."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    p = "(1 + ({scale}::HUGEINT * ({n} + {smooth})) // greatest({total} + {smooth} * {v}, 1))::BIGINT"
    p = p.replace("{scale}", str(SCALE)).replace("{smooth}", str(SMOOTHING))
    f = "(({p}::HUGEINT - {q}) * ({p}::HUGEINT - {q})) // ({p} + {q})"
    own, q = p.format(n="coalesce(c.n, 0)", total="g.total", v="g.v"), p.format(n="k.n", total="g.all_total", v="g.v")
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, translate(coalesce(text, ''), '{capitals}', '{small}') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
      FROM documents),
    w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {least}),
    c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
    l AS (SELECT lang, count(*) AS v, sum(n) AS all_total FROM k GROUP BY ALL),
    g AS (
      SELECT s.lang, s.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v, coalesce(l.all_total, 0) AS all_total
      FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) t USING (lang, source) LEFT JOIN l USING (lang)),
    p AS (
      SELECT g.lang, g.source, k.term, c.n, {own} AS p, {q} AS q
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    sums AS (
      SELECT a.lang, a.source, b.source AS item, sum({f.format(p="a.p", q="b.p")}) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, ({f.format(p="p", q="q")})::BIGINT AS value FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
