"""Near duplicates by SimHash: fingerprints, and a self-join that walks pairs of binary-trie nodes.

A fingerprint has 64 bits. Two documents are linked if their fingerprints differ in at most ``budget``
bits. The join walks a binary trie over the distinct fingerprints. It starts from a node paired with
itself, goes down one bit at a time on both sides, adds a bit to the pair's error where the sides take
different branches, and drops the pair once the error passes the budget.

The trie is walked in ``budget + 1`` rotations, in each of which another block of bits leads. Fingerprints
within the budget agree on at least one block, so in some rotation they share the node below their leading
block, and no pair is missed. That node is the unit of work. A node with more than ``node_rows``
fingerprints is taken apart beforehand into pairs of deeper nodes, which are units of their own.

Links of dense clusters are not listed one by one. Each unit links a fingerprint to the first of its
cluster, skips node pairs that lie in one cluster already, and connected components finish the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh_name, keyed_texts, map_rows, parts, record, staged, text_or_empty
from ledgerlake.operators.joins import left_join_spread

SHINGLE = 3
BUDGET = 3
SEED = 42
# A trie node with more fingerprints is taken apart before it is given to a task.
NODE_ROWS = 50_000
# So many bits deeper at a time.
STEP = 8
# Node pairs walked at once in a task, and shingles hashed at once.
FRONTIER = 1 << 20
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text.

    Words are separated by ASCII white space and A-Z are lower-cased. A text with fewer words than a
    shingle has one shingle of all its words, and a text without words has the fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(length + 1) - 1
    starts, n = ends - length, max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        spans = zip(starts[at : min(n, at + SHINGLES_AT_ONCE)].tolist(), last[at : at + SHINGLES_AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row; a NULL text is empty. The bits are a signed long."""
    fields = [("doc_id", pa.int64()), ("fp", pa.int64())]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
        return record(fields, b.column("doc_id"), fps.view(np.int64))

    return map_rows(keyed_texts(docs), batch, "doc_id long, fp long")


def rotations(fps: DataFrame, budget: int) -> tuple[DataFrame, int]:
    """Each distinct fingerprint once per rotation, under the node its leading block names."""
    blocks = budget + 1
    width = 64 // blocks
    turned = fps.select("fp", F.explode(F.array(*(F.lit(i * width) for i in range(blocks)))).alias("turn")).select(
        "turn",
        F.expr("CASE WHEN turn = 0 THEN fp ELSE shiftleft(fp, turn) | shiftrightunsigned(fp, 64 - turn) END").alias("x"),
    )
    node = F.shiftrightunsigned("x", 64 - width)
    return turned.select(
        "turn", F.lit(width).alias("depth"), node.alias("a"), node.alias("b"), F.lit(0).alias("err"), F.lit(0).alias("side"), "x"
    ), width


UNIT = ["turn", "depth", "a", "b", "err"]


def deeper(rows: DataFrame, budget: int) -> DataFrame:
    """Node pairs replaced by the pairs of their descendants STEP bits down that are within the budget.

    A row joins one pair for each pattern of differing bits that its error still allows. ``side`` is 0
    where a node is paired with itself, else 1 for rows under ``a`` and 2 for rows under ``b``.
    """
    masks = sorted((m for m in range(1 << STEP) if m.bit_count() <= budget), key=lambda m: (m.bit_count(), m))
    step = F.least(F.lit(STEP), F.lit(64) - F.col("depth"))
    child = F.expr("shiftrightunsigned(x, 64 - depth - _step) & (shiftleft(1L, _step) - 1)")
    spread = (
        rows.withColumn("_step", step)
        .withColumn("_own", child)
        .withColumn("_mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))))
        .filter((F.expr("bit_count(_mask)") + F.col("err") <= budget) & F.expr("_mask < shiftleft(1L, _step)"))
    )
    other = F.col("_own").bitwiseXOR(F.col("_mask"))
    own_first = (F.col("side") == 1) | ((F.col("side") == 0) & (F.col("_own") <= other))
    low, high = F.when(own_first, F.col("_own")).otherwise(other), F.when(own_first, other).otherwise(F.col("_own"))
    return spread.select(
        "turn",
        (F.col("depth") + F.col("_step")).alias("depth"),
        F.expr("shiftleft(a, _step)").bitwiseOR(low).alias("a"),
        F.expr("shiftleft(b, _step)").bitwiseOR(high).alias("b"),
        (F.col("err") + F.expr("bit_count(_mask)")).cast("int").alias("err"),
        F.when((F.col("side") == 0) & (F.col("_mask") == 0), 0).when(own_first, 1).otherwise(2).alias("side"),
        "x",
    )


def units(fps: DataFrame, budget: int, node_rows: int) -> DataFrame:
    """Node pairs small enough for one task, with the fingerprints below them.

    Only whether a larger one is left comes to the driver. At depth 64 a node has one fingerprint, so
    the loop ends.
    """
    rows, depth = rotations(fps, budget)
    done = None
    while depth < 64:
        sizes = rows.groupBy(*UNIT).count().filter(F.col("count") > node_rows).drop("count")
        if sizes.isEmpty():
            break
        sizes = staged(sizes, "large-nodes")
        small = rows.join(sizes, UNIT, "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = staged(deeper(rows.join(sizes, UNIT, "left_semi"), budget), "deeper-nodes")
        depth += STEP
    return rows if done is None else done.unionByName(rows)


def settle(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after linking u with v; a label is the first position of its cluster."""
    while True:
        lu, lv = label[u], label[v]
        apart = lu != lv
        if not apart.any():
            return label
        u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
        np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
        while (label[label] != label).any():
            label = label[label]


def walk(x: np.ndarray, pairs: tuple[np.ndarray, ...], depth: int, budget: int, label: np.ndarray) -> np.ndarray:
    """Labels after walking node pairs (lo_a, hi_a, lo_b, hi_b, err), ranges of the sorted x, from a depth on."""
    stack = [(depth, pairs)]
    while stack:
        depth, (la, ha, lb, hb, err) = stack.pop()
        if len(la) > FRONTIER:
            half = len(la) // 2
            stack += [(depth, tuple(p[half:] for p in (la, ha, lb, hb, err))), (depth, tuple(p[:half] for p in (la, ha, lb, hb, err)))]
            continue
        own = la == lb
        single = (ha - la == 1) & (hb - lb == 1)
        leaf = single & ~own
        close = np.bitwise_count(x[la[leaf]] ^ x[lb[leaf]]) <= budget
        if close.any():
            label = settle(label, la[leaf][close], lb[leaf][close])
        # Pairs whose members are in one cluster already need no further walk.
        change = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
        joined = (change[ha - 1] == change[la]) & (change[hb - 1] == change[lb]) & (label[la] == label[lb])
        go = ~single & ~joined
        la, ha, lb, hb, err, own = (p[go] for p in (la, ha, lb, hb, err, own))
        if not len(la) or depth >= 64:
            continue
        bit = (x >> np.uint64(63 - depth)) & np.uint64(1)
        ones = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        ma, mb = ha - (ones[ha] - ones[la]), hb - (ones[hb] - ones[lb])
        cross = ~own
        nexts = [
            np.concatenate(c)
            for c in zip(
                (la, ma, lb, mb, err),
                (ma, ha, mb, hb, err),
                (la, ma, mb, hb, err + 1),
                (ma[cross], ha[cross], lb[cross], mb[cross], err[cross] + 1),
                strict=True,
            )
        ]
        alive = (nexts[0] < nexts[1]) & (nexts[2] < nexts[3]) & (nexts[4] <= budget)
        stack.append((depth + 1, tuple(p[alive] for p in nexts)))
    return label


def stars(unit_rows: DataFrame, budget: int, partitions: int) -> DataFrame:
    """(u, v): each fingerprint that has a neighbour in a unit, with the first of its cluster there."""

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        cols = pa.Table.from_batches(got)
        turn, depth, a, b, err, side = (cols.column(c).to_numpy() for c in ("turn", "depth", "a", "b", "err", "side"))
        x = np.ascontiguousarray(cols.column("x").to_numpy()).view(np.uint64)
        order = np.lexsort((x, side, err, b, a, depth, turn))
        turn, depth, a, b, err, side, x = (c[order] for c in (turn, depth, a, b, err, side, x))
        same_as_before = np.ones(len(x) - 1, dtype=bool)
        for c in (turn, depth, a, b, err, side):
            same_as_before &= c[1:] == c[:-1]
        lo = np.flatnonzero(np.concatenate(([True], ~same_as_before)))
        hi = np.append(lo[1:], len(x))
        # A cross pair has two ranges in a row, side 1 then side 2; a lone side has no partner.
        first = side[lo] == 0
        followed = np.zeros(len(lo), dtype=bool)
        if len(lo) > 1:
            i, j = lo[:-1], lo[1:]
            same = (side[i] == 1) & (side[j] == 2)
            for c in (turn, depth, a, b, err):
                same &= c[i] == c[j]
            followed[:-1] = same
        mate = np.minimum(np.arange(len(lo)) + 1, len(lo) - 1)
        use = np.flatnonzero(first | followed)
        partner = np.where(first[use], use, mate[use])
        label = np.arange(len(x))
        levels = depth[lo[use]]
        for d in np.unique(levels):
            k = levels == d
            pairs = (lo[use][k], hi[use][k], lo[partner][k], hi[partner][k], err[lo[use]][k].astype(np.int64))
            label = walk(x, pairs, int(d), budget, label)
        t = turn.astype(np.uint64)
        back = np.where(t == 0, x, (x >> t) | (x << ((np.uint64(64) - t) % np.uint64(64)))).view(np.int64)
        linked = np.flatnonzero((label != np.arange(len(x))) & (back != back[label]))
        yield record([("u", pa.int64()), ("v", pa.int64())], back[linked], back[label[linked]])

    return unit_rows.repartition(partitions, *UNIT[:4]).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for nodes that have an edge.

    Large-star and small-star steps in turn: each ties a node's neighbours to the smallest of them. They
    repeat until no edge changes; only the count and sum of edges come to the driver.
    """
    edges = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = left_join_spread(both.filter("v > u"), low, "u", ["m"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = left_join_spread(large, low, "u", ["m"]).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = staged(small.filter("u <> v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, node_rows: int = NODE_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, its own included. NULL texts are empty;
    empty texts have the fingerprint 0 and are linked like others. Repeated rows stay. A row without a
    doc_id gets the component of its text, NULL if no member has a doc_id. Other columns are ignored.
    """
    if not 0 <= budget <= 7:
        raise ValueError("the budget must leave blocks of 8 bits or more")
    found = staged(fingerprints(docs, shingle), "fingerprints")
    return with_components(found, budget, node_rows).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def with_components(found: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> DataFrame:
    """``found`` (doc_id, fp, ...), a stored table, with the component of each row: its root and its smallest doc_id."""
    firsts = staged(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    edges = stars(units(firsts.select("fp"), budget, node_rows), budget, parts(found.sparkSession))
    roots = components(edges)
    member = firsts.join(roots, firsts.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = staged(member, "members")
    ids = member.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = staged(left_join_spread(member, ids, "root", ["component_id"]).select("fp", "root", "component_id"), "components")
    return left_join_spread(found, by_fp, "fp", ["root", "component_id"]).drop("_matched")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: one with the smallest doc_id.

    Rows are told apart by two hashes of all their columns, so a document stays whatever others share its doc_id; of
    rows that are equal in every column one stays. Rows without a doc_id stay. Columns that Spark can't hash (maps)
    don't count.
    """
    columns = docs.columns
    one, two = fresh_name(columns, "hash_one"), fresh_name(columns, "hash_two")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = docs.withColumns({one: F.xxhash64(*hashed), two: F.xxhash64(F.lit(1), *hashed)})
    fields = [("doc_id", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("fp", pa.int64())]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
        return record(fields, b.column("doc_id"), b.column("one"), b.column("two"), fps.view(np.int64))

    rows = keyed.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(one).alias("one"), F.col(two).alias("two"), text_or_empty().alias("text"))
    found = staged(map_rows(rows, batch, "doc_id long, one long, two long, fp long"), "fingerprints")
    # Of rows with the smallest doc_id those with the smallest hashes; a component's rows need not come together.
    stays = with_components(found, budget).groupBy("root").agg(F.min(F.struct("doc_id", "one", "two")).alias("kept"))
    keys = stays.select(F.col("kept.one").alias(one), F.col("kept.two").alias(two))
    named = keyed.filter(F.col("doc_id").isNotNull()).join(keys, [one, two], "left_semi").dropDuplicates([one, two])
    return named.select(*columns).unionByName(docs.filter(F.col("doc_id").isNull()))
