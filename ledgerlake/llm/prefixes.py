"""Conversation prefix trie by van Emde Boas recursion: who shares which opening turns.

A node of the trie is a distinct sequence of the first d turns of some conversation. The trie is built by cutting it
at half its depth again and again:

* From the bottom up, blocks of 1, 2, 4, ... turns get names; a block's name is made of the names of its halves.
* From the top down, every conversation's stretch is cut in two. The prefix up to the cut gets a name from the name of
  the prefix before the stretch and that of the stretch's first half. It roots the lower forest's stretches; the
  upper trie's keep the root they had. All stretches of a level are cut at once, and after log2(depth) levels each is
  one turn below a named prefix: an edge of the trie.
* From the bottom up again, totals are grafted. At a level, every cut prefix gets the sum of what its lower forest has
  gathered, and adds it to each of its ancestors in the upper trie, the nodes between the stretch's start and the cut.

So a conversation of any length takes log2(depth) rounds of joins and sums, no task follows one from end to end, and a
hot first turn is one name that map tasks count before the shuffle. Names are 128 bits of SHA-256; in results a node
is known by its smallest member and depth.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import parts, record, staged
from ledgerlake.operators.joins import left_join_spread
from ledgerlake.operators.ranks import number_rows

# The conversation whose opening another one takes has the next lower multiple of GROUP; it takes MOST - 1 turns at most.
GROUP, MOST = 100, 6
ROOT = ""
# Ids of conversations that end at a node are listed in pieces, each of so many consecutive ids (as a power of two).
PIECE_BITS = 12


def named(*names: str | Column) -> Column:
    """A name for a sequence of names; the parts have one length each, so sequences do not run together."""
    return F.substring(F.sha2(F.concat(*names).cast("binary"), 256), 1, 32)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, nth, turns, symbol, chars): each turn's place from 1, and the turns of its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text)
    symbol = named(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", symbol.alias("symbol"), F.length("text").cast("long").alias("chars"))
    return number_rows(rows, "conv_id", "turn", ["role", "symbol"], "nth", "turns").select("conv_id", "nth", "turns", "symbol", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, symbol, chars) of the rebuilt conversations, places from 0, and (conv_id, length) of all of them.

    ``turns`` must be a stored table.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST
    one = turns.filter("nth = 1").select("conv_id", "turns", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("opener"))
    # At most MOST - 1 turns of an opener, and at most GROUP conversations with it on either side of 0.
    opening = F.array_sort(F.collect_list(F.struct("nth", "symbol", "chars")))
    openings = turns.filter((F.col("nth") < MOST) & (F.col("conv_id") % GROUP == 0)).groupBy(F.col("conv_id").alias("opener")).agg(opening.alias("opening"))
    one = one.join(openings, "opener", "left").withColumn("opening", F.coalesce(F.slice("opening", F.lit(1), F.col("taken").cast("int")), F.array().cast("array<struct<nth:bigint,symbol:string,chars:bigint>>")))
    one = staged(one.select("conv_id", "turns", "taken", "opening", F.size("opening").cast("long").alias("before")), "openings")
    borrowed = one.select("conv_id", F.inline("opening")).select("conv_id", (F.col("nth") - 1).alias("at"), "symbol", "chars")
    own = turns.select("conv_id", "nth", "symbol", "chars").join(one.select("conv_id", "taken", "before"), "conv_id").filter("nth > taken")
    own = own.select("conv_id", (F.col("before") + F.col("nth") - F.col("taken") - 1).alias("at"), "symbol", "chars")
    lengths = one.select("conv_id", (F.col("before") + F.greatest(F.col("turns") - F.col("taken"), F.lit(0))).alias("length"))
    return borrowed.unionByName(own), lengths


def block_names(rows: DataFrame, levels: int) -> list[DataFrame]:
    """For each level below ``levels`` the (conv_id, block, name) of the full blocks of 2^level turns."""
    names = [rows.select("conv_id", F.col("at").alias("block"), F.col("symbol").alias("name"))]
    while len(names) < levels:
        halves = names[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            F.min_by("name", "block").alias("left"), F.max_by("name", "block").alias("right"), F.count("*").alias("n")
        )
        names.append(staged(halves.filter("n = 2").select("conv_id", "block", named("left", "right").alias("name")), "block-names"))
    return names


def edges(rows: DataFrame, lengths: DataFrame, levels: int) -> DataFrame:
    """(conv_id, at, root): for each turn the name of the prefix before it, by cutting stretches in halves."""
    names = block_names(rows, levels)
    stretches = lengths.filter("length > 0").select("conv_id", "length", F.lit(0).cast("long").alias("block"), F.lit(ROOT).alias("root"))
    for level in reversed(range(levels)):
        halved = stretches.withColumn("block", F.col("block") * 2).join(names[level], ["conv_id", "block"], "left")
        upper = F.struct("block", "root")
        lower = F.struct((F.col("block") + 1).alias("block"), named("root", "name").alias("root"))
        goes_on = F.col("length") > (F.col("block") + 1) * 2**level
        halves = F.when(goes_on, F.array(upper, lower)).otherwise(F.array(upper))
        stretches = halved.select("conv_id", "length", F.inline(halves))
    return stretches.select("conv_id", F.col("block").alias("at"), "root")


def grafted(nodes: DataFrame, walk: DataFrame, levels: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved): totals of the nodes' subtrees.

    ``nodes`` (conv_id, depth, parent, n_leaves, saved) have what each node has itself. ``walk`` (conv_id, at, node) has
    the node that each conversation is at after a turn.
    """
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved")]
    for level in range(levels):
        size = 2**level
        # Lower forests begin below the nodes that lie half way into a stretch of twice the size.
        tops = nodes.filter((F.col("depth") - 1) % (2 * size) == size)
        cuts = tops.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("cut")).agg(*sums)
        cuts = cuts.select("conv_id", (F.floor((F.col("cut") - 1) / size)).alias("stretch"), "n_leaves", "saved")
        path = walk.select("conv_id", F.floor(F.col("at") / size).alias("stretch"), "at", "node")
        more = path.join(cuts, ["conv_id", "stretch"]).groupBy(F.col("node").alias("conv_id"), (F.col("at") + 1).alias("depth")).agg(*sums)
        more = more.withColumn("parent", F.lit(None).cast("long")).select("conv_id", "depth", "parent", "n_leaves", "saved")
        nodes = nodes.unionByName(more).groupBy("conv_id", "depth").agg(F.max("parent").alias("parent"), *sums)
        nodes = staged(nodes, "grafted")
    return nodes


def ends(last: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of nodes where conversations end; ``last`` has (node, depth, member).

    A digest goes through its node's ids in order. They come as texts of up to 2^PIECE_BITS consecutive ids, made in
    parallel, and a task holds one text at a time.
    """
    piece = F.shiftright("member", PIECE_BITS)
    ids = F.array_join(F.transform(F.array_sort(F.collect_set("member")), lambda x: x.cast("string")), ",")
    pieces = last.groupBy("node", "depth", piece.alias("piece")).agg(ids.alias("ids"))
    fields = [("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]

    def run(batches):
        at, digest = None, None
        for b in batches:
            made = []
            for node, depth, ids in zip(*(b.column(c).to_pylist() for c in ("node", "depth", "ids")), strict=True):
                if at != (node, depth):
                    if at:
                        made.append((*at, digest.hexdigest()))
                    at, digest = (node, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if made:
                yield record(fields, *zip(*made, strict=True))
        if at:
            yield record(fields, *zip((*at, digest.hexdigest()), strict=True))

    spread = pieces.repartition(parts(last.sparkSession), "node", "depth").sortWithinPartitions("node", "depth", "piece")
    return spread.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row for each node.

    Turns are ordered by turn (NULL first), then by role and a digest of the turn; a NULL role or text is empty.
    Repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out. Texts
    may be of any length; after the first step only their digests and lengths travel. An empty table has no nodes.
    Other columns are ignored.
    """
    turns = staged(numbered_turns(conversations), "turns")
    rows, lengths = rebuilt(turns)
    rows, lengths = staged(rows, "rebuilt"), staged(lengths, "lengths")
    deepest = lengths.agg(F.max("length")).first()[0] or 0
    levels = max(0, deepest - 1).bit_length()

    # Each turn leads to a node, named by the prefix before it and the turn.
    steps = rows.join(edges(rows, lengths, levels), ["conv_id", "at"]).select("conv_id", "at", "chars", named("root", "symbol").alias("name"))
    steps = staged(steps, "steps")
    found = steps.groupBy("name").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.min("at").alias("at"), F.min("chars").alias("chars")
    )
    found = staged(found, "nodes")
    walk = staged(left_join_spread(steps.select("conv_id", "at", "name"), found, "name", ["node"]).select("conv_id", "at", "node"), "walk")

    # A node's parent is where its smallest member is one turn earlier; the root is the smallest member of all.
    first = lengths.agg(F.min("conv_id").alias("first"), F.count("*").alias("n_convs"))
    above = walk.select(F.col("conv_id").alias("node"), (F.col("at") + 1).alias("at"), F.col("node").alias("parent"))
    nodes = found.join(above, ["node", "at"], "left").select(
        F.col("node").alias("conv_id"), (F.col("at") + 1).alias("depth"), "parent", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    )
    top = first.filter("first IS NOT NULL").select("first", F.col("n_convs").alias("all_convs"))
    # One row.
    nodes = nodes.crossJoin(F.broadcast(top.select("first"))).withColumn("parent", F.coalesce("parent", "first")).drop("first")
    children = nodes.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    children = staged(children, "children")
    root = top.select(F.col("first").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), F.col("all_convs").alias("n_convs"), F.lit(0).cast("long").alias("saved"))
    nodes = nodes.unionByName(root).join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = staged(nodes, "trie")

    own = nodes.select("conv_id", "depth", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), "saved")
    totals = grafted(own.filter("depth > 0"), walk, levels).select("conv_id", "depth", "n_leaves", "saved")
    below = totals.filter("depth = 1").select("n_leaves", "saved").unionByName(own.filter("depth = 0").select("n_leaves", "saved"))
    whole = below.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    totals = totals.unionByName(own.filter("depth = 0").select("conv_id", "depth").crossJoin(F.broadcast(whole)))

    last = lengths.filter("length > 0").select("conv_id", (F.col("length") - 1).alias("at")).join(walk, ["conv_id", "at"])
    last = last.select("node", (F.col("at") + 1).alias("depth"), F.col("conv_id").alias("member"))
    turnless = lengths.filter("length = 0").select(F.col("conv_id").alias("member")).crossJoin(F.broadcast(top.select(F.col("first").alias("node"))))
    last = last.unionByName(turnless.select("node", F.lit(0).cast("long").alias("depth"), "member"))
    none = F.lit(hashlib.sha256().hexdigest())
    key = ["conv_id", "depth"]
    return nodes.drop("saved").join(totals, key).join(ends(last), key, "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def oracle() -> str:
    """The SQL for trie(); it follows conversations turn by turn."""
    shifted = "list_reduce([xor(crc, b)] || range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"""xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, length(d) + 1), lambda i: ascii(substr(d, i, 1))::BIGINT), lambda crc, b: {shifted}))"""
    return f"""
    WITH RECURSIVE t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS nth
      FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS opener, {crc} % {MOST} AS h FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS d FROM t)),
    built AS (
      SELECT c.conv_id, 0 AS part, t.nth, role, text FROM c JOIN t ON t.conv_id = c.opener AND t.nth <= c.h
      UNION ALL SELECT c.conv_id, 1, t.nth, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.nth > c.h),
    b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, nth) AS depth, role, text FROM built),
    walk AS (
      SELECT conv_id, 0::BIGINT AS depth, '' AS name, 0::BIGINT AS chars FROM c
      UNION ALL
      SELECT b.conv_id, b.depth, sha256(w.name || strlen(b.role) || ':' || b.role || b.text), length(b.text)
      FROM walk w JOIN b ON b.conv_id = w.conv_id AND b.depth = w.depth + 1),
    nodes AS (SELECT depth, name, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved FROM walk GROUP BY depth, name),
    tree AS (
      SELECT n.*, up.name AS parent FROM nodes n LEFT JOIN walk up ON up.conv_id = n.conv_id AND up.depth = n.depth - 1),
    children AS (SELECT parent AS name, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY ALL),
    subtree AS (
      SELECT up.name, up.depth, sum(n.saved) AS saved, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
      FROM nodes n LEFT JOIN children k USING (name, depth) JOIN walk up ON up.conv_id = n.conv_id AND up.depth <= n.depth GROUP BY ALL),
    last AS (SELECT conv_id, arg_max(name, depth) AS name, max(depth) AS depth FROM walk GROUP BY conv_id),
    ends AS (SELECT name, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM last GROUP BY ALL)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
           s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM tree n JOIN subtree s USING (name, depth) LEFT JOIN children k USING (name, depth) LEFT JOIN ends e USING (name, depth)
      LEFT JOIN nodes p ON p.name = n.parent AND p.depth = n.depth - 1"""
