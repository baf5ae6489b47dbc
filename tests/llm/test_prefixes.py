"""The conversation prefix trie against a plain one, with its recursion in any depth."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerlake.llm import prefixes
from ledgerlake.llm.common import table


def plain_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    for said in turns.values():
        said.sort(key=lambda t: (t[0], t[1], t[2], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()[:32]))
    members, end = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        opener = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        path = tuple(t[2:] for t in turns.get(opener, [])[:h]) + tuple(t[2:] for t in turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        end[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[p] for p in children[path]]
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        totals[path] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return {
        (members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), *totals[p],
         hashlib.sha256(",".join(map(str, end[p])).encode()).hexdigest())
        for p in members
    }


def trie(spark, rows):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int")
    found = [tuple(r) for r in prefixes.trie(df).collect()]
    assert len(found) == len(set(found))
    return set(found)


def conversations(rng, ids, most, kinds=3):
    return [(c, t, rng.choice("ua"), rng.choice(["é", "hello", "x" * 20][:kinds])) for c in ids for t in range(rng.randrange(1, most + 1))]


@pytest.mark.parametrize("most", [2, 9, 40])
def test_equals_plain_trie(spark, most):
    rng = random.Random(most)
    rows = conversations(rng, [*range(60), *range(195, 260), 400, 777], most, 2)
    rng.shuffle(rows)
    assert trie(spark, rows) == plain_trie(rows)


def test_conversations(spark, sf_dir):
    df = table(spark, sf_dir, "conversations")
    want = plain_trie([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    assert {tuple(r) for r in prefixes.trie(df).collect()} == want


def test_nulls_ties_repeated_rows_and_negative_ids(spark):
    rows = [(100, None, "user", "first"), (100, 1, None, None), (100, 1, None, None), (100, 1, "user", "same"), (100, 2, "", ""), (100, 3, "b", "ü" * 50)]
    rows += [(c, t, "user", "same") for c in range(101, 130) for t in (None, 1, 1, 5, 6)]
    rows += [(None, 1, "user", "lost"), (None, None, None, None), (-5, 0, "user", "n"), (-105, 0, "user", "n"), (-100, 0, "user", "o"), (-100, 1, "user", "p")]
    rows += [(900 + c, 0, "x", "y") for c in range(30)]  # no opener: some are turnless
    found = trie(spark, rows)
    assert found == plain_trie(rows)
    root = next(r for r in found if r[1] == 0)
    assert root[2] is None and root[0] == -105 and root[7] != hashlib.sha256().hexdigest()


def test_turnless_conversations_only(spark):
    rows = [(c, 0, "u", "t") for c in range(1, 40) if zlib.crc32(str(c).encode()) % 6]
    found = trie(spark, rows)
    assert found == plain_trie(rows) and len(found) == 1


def test_empty_table(spark):
    assert trie(spark, []) == set()


def test_one_deep_conversation_and_a_large_group_of_copies(spark):
    """A chain of 700 turns, and copies whose ids need several pieces."""
    rows = [(7, t, "u", f"t{t}") for t in range(700)] + [(100 * c, 0, "u", "copy") for c in range(1, 300)] + [(100_000_000 + c, 0, "u", "copy") for c in range(0, 9000, 100)]
    assert trie(spark, rows) == plain_trie(rows)
