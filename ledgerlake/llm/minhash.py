"""Near duplicates by circulant MinHash, with banding and exact Jaccard verification.

Two permutations of the 2^32 positions that shingles hash to make a whole signature. The first scatters the shingles of
a set once; the second, shifted circularly by k, gives coordinate k as the least value in the set. So a coordinate
costs one mixing of a scattered position, and no hash functions of its own.

``bands`` bands of ``rows`` coordinates name buckets. Sets with a common bucket are candidates, and every link is
confirmed on the two full sets. At the threshold of 0.8 a pair shares none of 40 bands of 5 with a chance of about
one in ten million, as independent coordinates have it; those of one shifted permutation vary less.

Pairs of a bucket are not listed. A bucket's leader is the member with the least hash. First every member is compared with
one of its leaders, and what is linked is put together; a group of copies is mostly settled by that. Then members are
compared with all their leaders of other components. Buckets that still hold two components
are cut into tiles of bounded size, one kind for the leader's component and one for the rest, and pairs of tiles (not
of the leader's component among itself) go to tasks. There long signatures are compared, 2048 coordinates of one byte
from the same two permutations, in the first bucket that two sets share. What agrees as often as sets of the wanted
similarity do, but for a chance of one in ten million, is a candidate. A task returns only pairs that put its candidates
together, the likeliest ones, and these are verified on the full sets. Where that leaves some of a pair of tiles apart,
they go to a task once more with their full sets, which verifies their candidates until they are together. So every
pair of candidates is verified, of one component, ruled out by sizes, or ruled out by its signatures, whatever the
bucket's size, and what a task returns grows with its members, not with their square.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_rows, mix, parts, record, staged, taken_over, text_or_empty, word_hashes
from ledgerlake.llm.simhash import components
from ledgerlake.operators.joins import left_join_spread

SHINGLE, SIMILARITY = 2, 80  # words, percent
BANDS, ROWS = 40, 5
# Members of a tile, and their shingles, about; coordinates of a long signature; pairs whose signatures are compared at once.
TILE, TILE_SHINGLES, LONG, PAIRS = 1024, 1 << 21, 2048, 4096
# Deviations of the share of equal coordinates below which a pair is ruled out.
SURE = 5.2
# Positions that are mixed for all shifts at once.
AT_ONCE = 256

_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's n-word shingles, in order; fewer words make one shingle, none make none.

    Words are separated by ASCII white space, and A-Z are lower-cased.
    """
    words = word_hashes(text.lower())
    n = min(n, len(words))
    if not n:
        return words
    count = len(words) - n + 1
    h = np.full(count, n, dtype=np.uint64)
    for i in range(n):
        h = mix(h * _ODD + words[i : i + count])
    return np.unique(h)


def permuted(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the numbers below 2^32, in place: each step can be undone."""
    for shift, factor in ((16, first), (15, second)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


def signature(found: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates: the least of the second permutation's values, shifted by 0, 1, 2, ..."""
    scattered = permuted((found >> np.uint64(32)).astype(np.uint32), 0x21F0AAAD, 0xD35A2D97)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(scattered), AT_ONCE):
        values = permuted(scattered[at : at + AT_ONCE] - shifts, 0x7FEB352D, 0x846CA68B)
        np.minimum(least, values.min(axis=1), out=least)
    return least


def buckets(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The names of a set's buckets, one for each band."""
    coordinates = signature(found, bands * rows).reshape(bands, rows)
    name = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        name = mix(name * _ODD + coordinates[:, i])
    return name.view(np.int64)


def signed(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_id, buckets) of every row; a set without shingles has no id."""
    fields = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.string()), ("buckets", pa.list_(pa.int64()))]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for text in b.column("text").to_pylist():
            found = shingles(text, shingle)
            made.append((len(found), identity(found), buckets(found, bands, rows)) if len(found) else (0, None, None))
        return record(fields, b.column("doc_id"), b.column("text_key"), *zip(*made, strict=True))

    return map_rows(texts(docs), batch, "doc_id long, text_key long, n_shingles long, set_id string, buckets array<long>")


def texts(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def identity(found: np.ndarray) -> str:
    return hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest()


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of the wanted sets (node, doc_id, text_key, set_id), from the texts they are known by."""
    fields = [("node", pa.int64()), ("shingles", pa.list_(pa.int64()))]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch | None:
        made = []
        for node, set_id, text in zip(*(b.column(c).to_pylist() for c in ("node", "set_id", "text")), strict=True):
            found = shingles(text, shingle)
            if identity(found) == set_id:  # else another text has the key
                made.append((node, found.view(np.int64)))
        return record(fields, *zip(*made, strict=True)) if made else None

    of = wanted.select("node", "set_id", F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
    chosen = texts(docs).join(of, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    return map_rows(chosen.select("node", "set_id", "text"), batch, "node long, shingles array<long>").dropDuplicates(["node"])


def linked(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b, ...) whose full sets have so many percent of their shingles in common."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    pairs = pairs.withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return pairs.filter(100 * F.col("common").cast("long") >= similarity * union).drop("set_a", "set_b", "common")


def members_of(sets: DataFrame) -> DataFrame:
    """(bucket, node, size, lead, label): the sets of each bucket that has two or more, and the one that leads it."""
    # Ids may be consecutive, their hashes are not.
    rows = sets.select(F.explode("buckets").alias("bucket"), "node", "size", F.xxhash64("node").alias("place"))
    large = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("place", "node", "size")).alias("first")).filter("n > 1")
    named = large.select("bucket", F.col("first.node").alias("lead"), F.col("first.size").alias("lead_size"))
    return rows.join(named, "bucket").select("bucket", "node", "size", "lead", "lead_size", F.col("node").alias("label"))


def led(members: DataFrame, similarity: int) -> DataFrame:
    """(a, b, label_a, label_b): every member with the leaders of its buckets, each pair once."""
    fits = 100 * F.least("size", "lead_size") >= similarity * F.greatest("size", "lead_size")
    met = members.filter((F.col("node") != F.col("lead")) & fits)
    pairs = met.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    return pairs.withColumns({"label_a": F.col("a"), "label_b": F.col("b")})


def led_first(members: DataFrame, similarity: int) -> DataFrame:
    """(a, b, label_a, label_b): every member with one of its buckets' leaders, the one of the least hash.

    Near copies of a large group share buckets with the same leader, so a comparison each settles most of them.
    """
    fits = 100 * F.least("size", "lead_size") >= similarity * F.greatest("size", "lead_size")
    met = members.filter((F.col("node") != F.col("lead")) & fits).select("node", F.struct(F.xxhash64("lead").alias("place"), "lead").alias("led"))
    one = met.groupBy("node").agg(F.min("led").alias("led")).select("node", F.col("led.lead").alias("lead"))
    pairs = one.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    return pairs.withColumns({"label_a": F.col("a"), "label_b": F.col("b")})


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) of two components, with their labels."""
    pairs = pairs.select("a", "b")
    for side in "ab":
        named = found.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = left_join_spread(pairs, named, side, [f"label_{side}"]).drop("_matched")
    return pairs.filter("label_a <> label_b")


def long_signatures(full: DataFrame) -> DataFrame:
    """(node, signature): a byte of each of LONG coordinates."""
    fields = [("node", pa.int64()), ("signature", pa.binary())]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.asarray(x, dtype=np.int64).view(np.uint64) for x in b.column("shingles").to_numpy(zero_copy_only=False)]
        return record(fields, b.column("node"), [signature(x, LONG).astype(np.uint8).tobytes() for x in found])

    return map_rows(full, batch, "node long, signature binary")


def tiled(members: DataFrame) -> DataFrame:
    """``members`` of buckets with two components, once for each unit (bucket, left, right) of two tiles that meet.

    Tiles of the leader's component have numbers below 0, others from 0 up. No unit has two of the former.
    """
    lead = members.filter("node = lead").select("bucket", F.col("label").alias("main"))
    rows = members.join(lead, "bucket").withColumn("rest", F.col("label") != F.col("main"))
    kinds = {"rest": F.col("rest"), "main": ~F.col("rest")}
    counts = [f(F.when(of, F.col("size"))).alias(f"{x}_{n}") for x, of in kinds.items() for n, f in (("n", F.count), ("shingles", F.sum))]
    sizes = rows.groupBy("bucket").agg(*counts).filter("rest_n > 0")
    tiles = {f"{x}_tiles": F.ceil(F.greatest(F.col(f"{x}_n") / TILE, F.col(f"{x}_shingles") / TILE_SHINGLES)).cast("int") for x in kinds}
    rows = rows.join(sizes, "bucket").withColumns(tiles)
    hashed = F.xxhash64("node", F.lit(2))
    own = F.when(F.col("rest"), F.pmod(hashed, "rest_tiles")).otherwise(-1 - F.pmod(hashed, "main_tiles")).cast("int")
    others = F.sequence(F.when(F.col("rest"), -F.col("main_tiles")).otherwise(F.lit(0)), F.col("rest_tiles") - 1)
    met = rows.withColumn("own", own).withColumn("other", F.explode(others))
    return met.select("bucket", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "node", "label", "size")


def alike(units: DataFrame, known: DataFrame, similarity: int, partitions: int) -> DataFrame:
    """(bucket, left, right, a, b, label_a, label_b, equal): pairs that put together what a unit's candidates put together.

    Candidates are pairs of two labels that sizes and signatures do not rule out, in their first common bucket; ``equal``
    is how many coordinates agree. Of the candidates that would put the same two parts of a unit together the likeliest
    one is returned, so a unit has fewer pairs than labels.

    ``known`` has (node, signature, buckets). If it has ``shingles`` too, candidates are confirmed on these sets, each
    until its two labels are together: the pairs are links then, and no link of the unit is missed by them.
    """
    least = similarity / 100 + (1 - similarity / 100) / 256
    enough = int(np.floor(LONG * (least - SURE * np.sqrt(least * (1 - least) / LONG))))
    confirmed = "shingles" in known.columns
    unit = ["bucket", "left", "right"]
    fields = [
        ("bucket", pa.int64()), ("left", pa.int32()), ("right", pa.int32()),
        *((n, pa.int64()) for n in ("a", "b", "label_a", "label_b", "equal")),
    ]

    def pairs(rows: pa.Table) -> pa.RecordBatch | None:
        node, label, size, own = (rows.column(c).to_numpy() for c in ("node", "label", "size", "own"))
        signatures = np.stack([np.frombuffer(x, np.uint8) for x in rows.column("signature").to_pylist()])
        buckets = np.stack([np.asarray(x, np.int64) for x in rows.column("buckets").to_pylist()])
        sets = [x.view(np.uint64) for x in rows.column("shingles").to_numpy()] if confirmed else []
        at = [rows.column(c)[0].as_py() for c in unit]
        band = (buckets == at[0]).argmax(axis=1)
        within = at[1] == at[2]
        root = np.unique(label, return_inverse=True)[1]
        made: list[tuple[int, int, int]] = []
        for i in range(len(node)):
            if not within and own[i] != own.min():
                continue
            other = np.arange(i + 1, len(node)) if within else np.flatnonzero(own != own[i])
            fits = 100 * np.minimum(size[i], size[other]) >= similarity * np.maximum(size[i], size[other])
            other = other[(root[other] != root[i]) & fits]
            # Equal bands before this one: the pair is another bucket's.
            other = other[~(buckets[other, : band[i]] == buckets[i, : band[i]]).any(axis=1)]
            equal = np.concatenate([(signatures[x] == signatures[i]).sum(axis=1) for x in np.split(other, range(PAIRS, len(other), PAIRS))])
            order = np.argsort(-equal, kind="stable")
            order = order[equal[order] >= enough]
            other, equal = other[order], equal[order]
            while len(other):
                first = np.unique(root[other], return_index=True)[1]  # the likeliest of each part
                met = first[common(sets[i], [sets[j] for j in other[first]], similarity)] if confirmed else first
                made += [(i, j, n) for j, n in zip(other[met].tolist(), equal[met].tolist(), strict=True)]
                root[np.isin(root, root[other[met]])] = root[i]
                left = root[other] != root[i]
                left[first] = False
                other, equal = other[left], equal[left]
        if not made:
            return None
        i, j, equal = (np.array(x) for x in zip(*made, strict=True))
        swap = node[j] < node[i]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return record(fields, *(np.full(len(i), x) for x in at), node[i], node[j], label[i], label[j], equal)

    def run(batches):
        """A unit at a time; it has some two tiles of members."""
        taken_over("alike")
        key, rows = None, []
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in unit), strict=True))
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != key:
                    if rows and (out := pairs(pa.Table.from_batches(rows))):
                        yield out
                    key, rows = keys[at], []
                rows.append(b.slice(at, end - at))
                at = end
        if rows and (out := pairs(pa.Table.from_batches(rows))):
            yield out

    ready = units.join(known, "node").repartition(partitions, *unit).sortWithinPartitions(*unit, "node")
    return ready.mapInArrow(run, "bucket long, left int, right int, a long, b long, label_a long, label_b long, equal long")


def common(one: np.ndarray, others: list[np.ndarray], similarity: int) -> np.ndarray:
    """Whether sets, in order, have so many percent of their shingles in common with one."""
    sizes = np.array([len(x) for x in others])
    every = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, every), len(one) - 1)] == every
    both = np.add.reduceat(hit, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * both >= similarity * (len(one) + sizes - both)


def likeliest(pairs: DataFrame) -> DataFrame:
    """Of the pairs of any two components the one whose signatures agree most."""
    best = pairs.groupBy(F.least("label_a", "label_b").alias("u"), F.greatest("label_a", "label_b").alias("v"))
    return best.agg(F.max(F.struct("equal", "a", "b", "label_a", "label_b")).alias("best")).select("best.a", "best.b", "best.label_a", "best.label_b")


def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(label_a, label_b) of pairs whose components the roots do not put together."""
    kinds = pairs.select("label_a", "label_b").distinct()
    for side in "ab":
        named = kinds.withColumn("label", F.col(f"label_{side}"))
        kinds = relabelled(named, roots).withColumnRenamed("label", f"root_{side}")
    return kinds.filter("root_a <> root_b").select("label_a", "label_b")


def relabelled(df: DataFrame, roots: DataFrame) -> DataFrame:
    columns = df.columns
    named = roots.select(F.col("node").alias("label"), F.col("root").alias("_root"))
    return left_join_spread(df, named, "label", ["_root"]).withColumn("label", F.coalesce("_root", "label")).select(*columns)


def labels(docs: DataFrame, sets: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """(node, label): the component of every set that is a candidate. ``sets`` must be a stored table."""
    members = staged(members_of(sets), "bucket-members")
    known = members.select("node").distinct().join(sets, "node")
    full = staged(full_sets(docs, known, shingle), "full-sets")
    found = full.select("node", F.col("node").alias("label"))
    for pairs in (led_first, lambda *x: apart(led(*x), found)):
        links = staged(linked(pairs(members, similarity), full, similarity).select("label_a", "label_b").distinct(), "links")
        if not links.isEmpty():
            roots = components(links.select(F.col("label_a").alias("u"), F.col("label_b").alias("v")))
            found, members = staged(relabelled(found, roots), "labels"), relabelled(members, roots)
    units = staged(tiled(members), "units")
    if units.isEmpty():
        return found
    inside = units.select("node").distinct()
    signatures = long_signatures(full.join(inside, "node", "left_semi")).join(sets.select("node", "buckets"), "node")
    partitions = parts(docs.sparkSession)
    pairs = staged(alike(units, signatures, similarity, partitions), "pairs")
    # One pair of any two components first: most are linked by it, and units whose pairs are all settled need no more.
    links = staged(linked(likeliest(pairs), full, similarity).select("label_a", "label_b").distinct(), "links")
    if not links.isEmpty():
        roots = components(links.select(F.col("label_a").alias("u"), F.col("label_b").alias("v")))
        pairs, units = pairs.join(still_apart(pairs, roots), ["label_a", "label_b"], "left_semi"), relabelled(units, roots)
    units = staged(units.join(pairs.select("bucket", "left", "right").distinct(), ["bucket", "left", "right"], "left_semi"), "units-apart")
    if not units.isEmpty():
        more = alike(units, signatures.join(full, "node"), similarity, partitions)
        links = staged(more.select("label_a", "label_b").distinct().unionByName(links), "links")
    return found if links.isEmpty() else relabelled(found, components(links.select(F.col("label_a").alias("u"), F.col("label_b").alias("v"))))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    ``component_id`` is the smallest doc_id that links reach, its own included; ``kept`` is whether that is the row's
    own. NULL texts are empty; a text without words has no shingles, links with nothing and is kept. Repeated rows stay,
    and rows with one doc_id and different texts are linked by their texts. A row without a doc_id gets the component of
    its text, and is kept if no member has a doc_id. Other columns are ignored.
    """
    found = staged(signed(docs, shingle, bands, rows), "signatures")
    known = found.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "text_key")).alias("known_by"),
        F.min("n_shingles").alias("size"), F.any_value("buckets").alias("buckets"),
    )
    # Numbered as they are written, and read from there ever after.
    sets = staged(known.select(F.monotonically_increasing_id().alias("node"), "set_id", "first", "known_by.doc_id", "known_by.text_key", "size", "buckets"), "sets")
    label = labels(docs, sets, shingle, similarity)
    of = sets.select("node", "set_id", "first").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of = staged(of, "set-labels")
    ids = of.groupBy("label").agg(F.min("first").alias("component_id"))
    by_set = staged(left_join_spread(of, ids, "label", ["component_id"]).select("set_id", "component_id"), "components")
    joined = left_join_spread(found.select("doc_id", "n_shingles", "set_id"), by_set, "set_id", ["component_id"])
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def oracle(similarity: int = SIMILARITY) -> str:
    """The SQL for near_duplicates(): shingles of two words, all pairs with one in common, and everything reached by links."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH RECURSIVE w AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{small}'), '[^\\x20\\x09-\\x0D]+') AS words
      FROM documents),
    s AS (
      SELECT DISTINCT r, unnest(CASE WHEN len(words) = 1 THEN words ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle
      FROM w),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    common AS (SELECT a.r, b.r AS other, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
    links AS (
      SELECT c.r, c.other FROM common c JOIN n a ON a.r = c.r JOIN n b ON b.r = c.other WHERE 100 * shared >= {similarity} * (a.n + b.n - shared)),
    reach AS (SELECT r, r AS other FROM w UNION SELECT reach.r, links.other FROM reach JOIN links ON links.r = reach.other),
    c AS (SELECT reach.r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.other GROUP BY reach.r)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(w.doc_id = c.component_id, c.component_id IS NULL) AS kept
    FROM w JOIN c USING (r) LEFT JOIN n USING (r)"""
