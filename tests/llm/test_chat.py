"""Chat windows: reversible, within the budget, every assistant text a target once."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import chat
from ledgerlake.llm.common import table

SCHEMA = "conv_id long, turn int, role string, text string, place int"


def plain(rows):
    by = {}
    for c, turn, role, text, _ in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = set()
    for c, ts in by.items():
        ts.sort()
        loss = b"".join(t for *_, r, t in ts if r == b"assistant")
        said = b"".join(r + b"\n" + t + b"\n" for *_, r, t in ts)
        out.add((c, len(ts), hashlib.sha256(said).hexdigest(), len(loss.decode()), hashlib.sha256(loss).hexdigest()))
    return out


@pytest.mark.parametrize(("budget", "history"), [(512, 96), (40, 20), (60, 0), (2, 1)])
def test_windows_of_random_conversations(spark, budget, history):
    rng = random.Random(budget)
    parts = ["<|im_end|>", "<|im_start|>assistant", "\\", "<\\p|", "\\b", "\\n", "\n", "<", "|", "é", "word ", "<<||", "\\p"]
    rows = [
        (rng.choice([None, *range(6)]), rng.choice([None, *range(30), 1500, 2999]), rng.choice(["system", "user", "assistant", None, "to<|ol\n\\n"]),
         rng.choice([None, "".join(rng.choices(parts, k=rng.randrange(30)))]), 1)
        for _ in range(250)
    ]
    rows += [(100, 0, "system", "be short", 0), (101, 5, "system", "x" * 900, 0), (101, 6, "user", "hi", 0), (101, 7, "assistant", "ho", 0), (102, 0, "user", "a" * 5000, 0)]
    rows += [(103, 3, "assistant", "same", 0)] * 3 + [(104, i, "user", None, 0) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = chat.windows(df, budget, history)
    got = chat.digests(chat.read_back(made))
    assert {tuple(r)[:5] for r in got.collect()} == plain(rows)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn int, role text, text text)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", [r[:4] for r in rows if r[0] != 104])
    want = {tuple(r) for r in con.sql(chat.oracle(budget, history)).fetchall()}
    assert {tuple(r) for r in got.filter("conv_id is null or conv_id <> 104").collect()} == want
    for r in made.collect():
        bodies = r.text.split(chat.START)[1:]
        system = bodies[0].startswith("system\n") and r.repeated > 0
        new = len(bodies) - r.repeated
        assert new >= 1 and (not r.over_budget or new <= 2 or r.window == 0 or system)


def test_documents_equal_sql(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    want = {tuple(r) for r in con.sql(chat.oracle()).fetchall()}
    assert {tuple(r) for r in chat.digests(chat.read_back(chat.windows(rows))).collect()} == want


def test_history_and_system_turn_are_repeated(spark):
    rows = [(1, 0, "system", "rule", 0)] + [(1, i, "assistant" if i % 2 == 0 else "user", f"text number {i}", 0) for i in range(1, 20)]
    made = chat.windows(spark.createDataFrame(rows, SCHEMA), budget=80, history=30).orderBy("window").collect()
    assert len(made) > 3 and not any(r.over_budget for r in made)
    for r in made[1:]:
        assert r.text.startswith("<|im_start|>system\nrule<|im_end|>\n") and r.repeated >= 2
    targets = [r.text[s.start : s.start + s.length] for r in made for s in r.loss]
    assert targets == [f"text number {i}" for i in range(2, 20, 2)]


def test_empty_table_and_native_plan(spark):
    from tests.conftest import plan_of

    empty = spark.createDataFrame([], SCHEMA)
    assert chat.windows(empty).collect() == []
    plan = plan_of(chat.digests(chat.read_back(chat.windows(empty.withColumn("role", F.lit("user"))))))
    assert "Python" not in plan and "Arrow" not in plan


def test_cautious_tokens_hold_the_budget_for_digits_marks_and_scripts(spark):
    said = ["世界" * 40, "1234567890" * 8, "{}[]();" * 10, "plain words " * 8]
    rows = [(1, i, "user" if i % 2 else "assistant", said[i % 4], 0) for i in range(24)]
    made = chat.windows(spark.createDataFrame(rows, SCHEMA), tokens=chat.cautious_tokens).collect()
    assert sum(len(r.loss) for r in made) == 12
    for r in made:
        dense = sum(len(c.encode()) for c in r.text if not (c.isascii() and (c.isalpha() or c in " \n")))
        assert dense <= r.tokens and (r.tokens <= chat.BUDGET or r.over_budget)
