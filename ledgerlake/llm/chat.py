"""Chat formatting in budgeted windows, by DataFrame operations only.

A conversation's turns are written between control strings. Control strings inside texts are escaped, so a
reader gets every turn back. Prefix sums of the turns' tokens cut the conversation into spans of whole turns:
turn t opens ``stride`` number floor(before / stride); a turn that would pass the end of its stride makes a
span by itself. So no step depends on the one before it, and long conversations are cut in parallel.

A window repeats the system turn, then turns just before its span with up to ``history`` tokens, then has
its span. The loss mask covers assistant texts of the span only, so each is a target once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The control strings.
START, END = "<|im_start|>", "<|im_end|>\n"
BUDGET, HISTORY = 512, 96
# Turn numbers whose sums are taken together before conversations are put together.
BLOCK = 1000


def escaped(text: Column, line: bool = False) -> Column:
    """Text without control strings: a backslash gets a b, and a broken bracket is taken apart.

    In a ``line``, line ends are written as letters, too.
    """
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if line else out


def unescaped(text: Column) -> Column:
    """What escaped() was given: each backslash is followed by the letter that tells what it stands for."""
    out = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit(""))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def estimated_tokens(body: Column) -> Column:
    """A token for every four characters begun."""
    return F.ceil(F.length(body) / 4).cast("long")


def cautious_tokens(body: Column) -> Column:
    """An estimate that errs on the high side: four ASCII letters or blanks make a token, any other byte makes one."""
    rest = F.regexp_replace(body, "[A-Za-z \\n]", "")
    return (F.ceil((F.length(body) - F.length(rest)) / 4) + F.octet_length(rest)).cast("long")


def turns(conversations: DataFrame, tokens=estimated_tokens) -> DataFrame:
    """Each turn's body, place in its conversation, tokens, and tokens before it; the system turn counts none.

    Turns are ordered by turn, role and text, NULL turns first; a NULL role or text is empty. Sums are taken
    by blocks of turn numbers first, so a conversation with most of the turns is no single task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(START), escaped(F.col("role"), line=True), F.lit("\n"))
    rows = rows.withColumn("head", F.length(head)).withColumn("body", F.concat(head, escaped(F.col("text")), F.lit(END)))
    rows = rows.select("conv_id", "turn", "role", "text", "head", "body", tokens(F.col("body")).alias("n"), F.floor(F.col("turn") / BLOCK).alias("block"))
    within = W.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumns({"nth": F.row_number().over(within) - 1, "sum": F.sum("n").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")})
    blocks = rows.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), F.sum("n").alias("tokens"), F.min_by(F.struct("role", "n"), "nth").alias("first"))
    before = W.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    earlier = before.rowsBetween(W.unboundedPreceding, -1)
    opening = F.first("first").over(before)
    blocks = blocks.select(
        F.col("conv_id").alias("_c"), F.col("block").alias("_b"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
        F.when(opening["role"] == "system", opening["n"]).otherwise(0).alias("system"),
    )
    rows = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("block").eqNullSafe(F.col("_b")))
    place = F.col("turns_before") + F.col("nth")
    at = F.col("tokens_before") + F.col("sum") - F.when(place > 0, F.col("system")).otherwise(0)
    is_system = (place == 0) & (F.col("system") > 0)
    return rows.select("conv_id", place.alias("place"), "role", "head", "body", "n", "system", is_system.alias("is_system"), at.alias("at"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=estimated_tokens) -> DataFrame:
    """(conv_id, window, text, loss, repeated, tokens, over_budget), one row for each window.

    ``loss`` lists (start, length) of the target texts in code points of ``text``, and the first ``repeated``
    turns were in earlier windows. A window exceeds the budget only by a single turn that is too long, or a
    system turn that leaves no room. Repeated rows are turns of their own; turns without a conv_id make one
    conversation. Other columns are ignored, and no turns make no windows.

    The budget is in tokens as ``tokens`` estimates them. The default takes four characters for one, too few
    tokens for digits, marks and scripts with a token a character or more; cautious_tokens() is made for those.
    """
    if not 0 <= history <= budget // 2:
        raise ValueError("history must take half of the budget at most")
    # Room for new turns is never less than the history repeated, so history reaches into the stride before only.
    stride = F.greatest(F.lit(budget) - F.col("system") - history, F.lit(max(history, 1)))
    rows = turns(conversations, tokens).withColumn("stride", stride)
    nth = F.floor(F.col("at") / F.col("stride"))
    alone = ~F.col("is_system") & (F.col("at") + F.col("n") > (nth + 1) * F.col("stride"))
    rows = rows.withColumn("window", F.when(F.col("is_system"), 0).otherwise(2 * nth + alone.cast("long")).cast("long"))
    item = ["body", "head", "role", "place", "n"]
    own = rows.select("conv_id", "window", F.lit(2).alias("part"), *item)
    opens = rows.filter(~F.col("is_system")).groupBy(F.col("conv_id").alias("_c"), F.col("window").alias("_w")).agg(F.min("at").alias("opens"))
    reach = rows.filter(~F.col("is_system")).withColumn("_next", F.explode(F.array(*((2 * nth + F.lit(i)).cast("long") for i in (1, 2, 3)))))
    same = F.col("conv_id").eqNullSafe(F.col("_c"))
    past = reach.join(opens, same & (F.col("_next") == F.col("_w"))).filter((F.col("at") < F.col("opens")) & (F.col("at") >= F.col("opens") - history))
    past = past.select("conv_id", F.col("_w").alias("window"), F.lit(1).alias("part"), *item)
    system = rows.filter("is_system").select("conv_id", *item)
    kept = opens.filter("_w > 0").join(system, same).select("conv_id", F.col("_w").alias("window"), F.lit(0).alias("part"), *item)
    # A window's turns are bounded by the budget.
    one = own.unionByName(past).unionByName(kept).groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("part", "place", "body", "head", "role", "n"))).alias("items"))
    empty = F.expr("named_struct('at', 0, 'spans', CAST(array() AS array<struct<start:int,length:int>>))")

    def step(state: Column, x: Column) -> Column:
        length = F.length(x["body"])
        span = F.struct((state["at"] + x["head"]).cast("int").alias("start"), (length - x["head"] - len(END)).cast("int").alias("length"))
        target = (x["part"] == 2) & (x["role"] == "assistant")
        return F.struct((state["at"] + length).cast("int").alias("at"), F.when(target, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    total = F.aggregate("items", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return one.select(
        "conv_id", "window", F.array_join(F.transform("items", lambda x: x["body"]), "").alias("text"),
        F.aggregate("items", empty, step)["spans"].alias("loss"),
        F.size(F.filter("items", lambda x: x["part"] < 2)).alias("repeated"), total.alias("tokens"), (total > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, targets): each window's new turns, and its target texts, as they were before."""
    bodies = F.split("text", START.replace("|", "\\|"))
    bodies = F.slice(bodies, F.col("repeated") + 2, F.size(bodies))
    pair = F.transform(bodies, lambda b: F.split(F.substring(b, F.lit(1), F.length(b) - len(END)), "\n", 2))
    parsed = F.transform(pair, lambda p: F.struct(unescaped(p[0]).alias("role"), unescaped(p[1]).alias("text")))
    targets = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "window", F.length("text").alias("chars"), parsed.alias("turns"), targets.alias("targets"))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of each conversation. A digest needs a conversation's whole text in one place."""
    whole = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"), F.sum("chars").cast("long").alias("formatted_chars")
    )
    said = F.flatten(F.transform("w", lambda x: x["turns"]))
    target = F.array_join(F.flatten(F.transform("w", lambda x: x["targets"])), "")
    text = F.array_join(F.transform(said, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size(said).cast("long").alias("n_turns"), F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"), F.sha2(target.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def oracle(budget: int = BUDGET, history: int = HISTORY, block: str = "conversations") -> str:
    """The SQL for digests(read_back(windows(...)))."""
    escape = "replace(replace({0}, chr(92), chr(92) || 'b'), '<|', '<' || chr(92) || 'p|')"
    return f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             length({escape.format("replace(coalesce(role, ''), chr(10), '..')")}) + length({escape.format("coalesce(text, '')")}) + {len(START) + 1 + len(END)} AS len
      FROM {block}),
    n AS (
      SELECT *, (len + 3) // 4 AS n, row_number() OVER o - 1 AS place, first_value(role) OVER o = 'system' AS has, first_value((len + 3) // 4) OVER o AS lead,
             sum((len + 3) // 4) OVER (o ROWS UNBOUNDED PRECEDING) - (len + 3) // 4 AS upto
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    p AS (
      SELECT *, has AND place = 0 AS sys, upto - CASE WHEN has AND place > 0 THEN lead ELSE 0 END AS pos,
             greatest({budget} - CASE WHEN has THEN lead ELSE 0 END - {history}, {max(history, 1)}) AS stride FROM n),
    w AS (
      SELECT *, CASE WHEN sys THEN 0 ELSE 2 * (pos // stride) + CASE WHEN pos + n > (pos // stride + 1) * stride THEN 1 ELSE 0 END END AS win FROM p),
    opens AS (SELECT conv_id, win, min(pos) AS opens FROM w WHERE NOT sys GROUP BY ALL),
    again AS (
      SELECT w.conv_id, sum(len) AS len FROM w JOIN opens o ON w.conv_id IS NOT DISTINCT FROM o.conv_id
       AND ((NOT w.sys AND w.pos < o.opens AND w.pos >= o.opens - {history}) OR (w.sys AND o.win > 0)) GROUP BY ALL)
    SELECT w.conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
      coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
      (sum(w.len) + coalesce(any_value(again.len), 0))::BIGINT AS formatted_chars
    FROM w LEFT JOIN again ON w.conv_id IS NOT DISTINCT FROM again.conv_id GROUP BY w.conv_id"""
