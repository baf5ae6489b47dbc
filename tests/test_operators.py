"""L1, W1-W4, J3, J5, J6, P3, A8, A9 and the generic data tests, against brute force."""

import random
from bisect import bisect_right
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import final_plan, plan_of, rows
from pyspark.sql import functions as F

from ledgerlake.operators import asof, checks, collisions, joins, profile, ranks, scd2


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one id, many of them the same moment."""
    rng = random.Random(5)
    start = datetime(2026, 3, 7)
    data = [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(400)}", start + timedelta(minutes=30 * rng.randrange(120)), f"r{i:04d}")
        for i in range(1500)
    ]
    return data, spark.createDataFrame(data, "key string, at timestamp_ntz, id string").repartition(5)


def test_w1_flag_collisions(hot):
    data, df = hot
    sizes = Counter(key for key, _, _ in data)
    got = collisions.flag_collisions(df.select("key", "id"), "key", "repeated", "n")
    assert rows(got.select("key", "id", "n", "repeated")) == sorted(
        (key, id_, sizes[key], sizes[key] > 1) for key, _, id_ in data
    )


def test_l1_policies(hot):
    data, df = hot
    order = [F.col("at"), F.col("id")]
    sizes = Counter(key for key, _, _ in data)
    none = collisions.resolve_collisions(df, "key", "quarantine_all", order)
    assert rows(none.select("key")) == sorted((k,) for k, n in sizes.items() if n == 1)
    assert rows(collisions.rows_with_unique_key(df, "key", hot_rows=50).select("key")) == rows(none.select("key"))
    earliest = collisions.resolve_collisions(df, "key", "keep_earliest", order)
    first = {}
    for key, at, id_ in data:
        first[key] = min(first.get(key, (at, id_)), (at, id_))
    assert rows(earliest.select("key", "id")) == sorted((k, v[1]) for k, v in first.items())
    with pytest.raises(ValueError, match="collision policy"):
        collisions.resolve_collisions(df, "key", "keep_latest", order)


def test_w2_numbers_equal_a_window_over_the_key(hot):
    data, df = hot
    groups = defaultdict(list)
    for key, at, id_ in data:
        groups[key].append((at, id_))
    expected = [
        (key, id_, n, len(group)) for key, group in groups.items() for n, (_, id_) in enumerate(sorted(group), 1)
    ]
    numbered = ranks.number_rows(df, "key", "at", ["id"], "n", "size").select("key", "id", "n", "size")
    assert rows(numbered) == sorted(expected, key=lambda r: tuple((False, str(v)) for v in r))


def test_w2_no_task_holds_all_rows_of_a_key(hot):
    plan = plan_of(ranks.number_rows(hot[1], "key", "at", ["id"], "n", "size"))
    row_windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert row_windows and all("windowspecdefinition(key#" in w and "_range#" in w for w in row_windows)


def test_w2_one_key_at_one_instant_is_spread_over_ranges(spark):
    """Half of all rows are one key at one instant: its rows fall into many ranges, and the numbers stay right."""
    data = [("hot", 7 if i % 2 else None, f"{i * 7919 % 20_000:05d}") for i in range(10_000)] + [(f"k{i % 4000}", i % 3, f"{i:05d}") for i in range(10_000)]
    df = spark.createDataFrame(data, "key string, at int, id string").repartition(6)
    ranged = ranks.with_ranges(df, "key", ["at", "id"], "part", rows_per_range=200)
    sizes = {(r.key, r.part): r.n for r in ranged.groupBy("key", "part").agg(F.count("*").alias("n")).collect()}
    hot_sizes = [n for (key, _), n in sizes.items() if key == "hot"]
    assert len(hot_sizes) > 25 and max(hot_sizes) < 2000 and sum(hot_sizes) == 10_000
    numbered = ranks.number_rows(df, "key", "at", ["id"], "n", "size", rows_per_range=200).collect()
    groups = defaultdict(list)
    for key, at, id_ in data:
        groups[key].append((at is not None, at or 0, id_))
    expected = {(key, r[2]): (n, len(group)) for key, group in groups.items() for n, r in enumerate(sorted(group), 1)}
    assert {(r.key, r.id): (r.n, r["size"]) for r in numbered} == expected


def test_w2_tasks_of_one_instant(spark):
    """The rows of one key at one instant reach many tasks of the numbering stage."""
    df = spark.range(20_000).selectExpr("'one' AS key", "0 AS at", "lpad(string(id), 6, '0') AS id")
    numbered = ranks.number_rows(df, "key", "at", ["id"], "n", "size", rows_per_range=500)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        per_task = [r.n for r in numbered.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(coalesce, "true")
    assert len(per_task) > 4 and max(per_task) < 10_000


def test_w2_cuts_are_found_by_halving(spark):
    df = spark.range(60).selectExpr("int(id) AS x", "transform(sequence(0, int(id % 9)), i -> int(i * 7)) AS cuts")
    found = df.select("x", "cuts", ranks.cuts_below(F.col("cuts"), F.col("x")).alias("n")).collect()
    assert all(r.n == sum(c <= r.x for c in r.cuts) for r in found)
    none = spark.range(1).selectExpr("1 AS x", "CAST(NULL AS array<int>) AS cuts", "CAST(array() AS array<int>) AS none")
    assert none.select(ranks.cuts_below(F.col("cuts"), F.col("x")), ranks.cuts_below(F.col("none"), F.col("x"))).first() == (0, 0)


def test_w3_top_one_is_cut_before_the_shuffle(hot):
    plan = plan_of(ranks.top_one(hot[1], ["key"], [F.col("at"), F.col("id")]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(key") < plan.index("Partial")


SMALL_SIZES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_sizes(spark):
    """Sizes at which the test's hot key counts as skewed."""
    before = {name: spark.conf.get(name) for name in SMALL_SIZES}
    for name, value in SMALL_SIZES.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_hot_keys_of_the_wide_joins_are_split(spark, small_sizes):
    wide = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.expr("date'2026-01-01' + cast(id % 80 as int)").alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    flagged = collisions.flag_collisions(wide, "key", "repeated", "n")
    assert "skew=true" in final_plan(flagged)
    # Also where the result goes on to a join on the same key.
    onward = flagged.join(wide.select("key", F.length("payload").alias("size")).filter("key <> 'hot'"), "key", "left")
    assert "skew=true" in final_plan(onward)
    prices = spark.createDataFrame([("hot", date(2026, 1, d), float(d)) for d in range(1, 29)], "key string, since date, v double")
    assert "skew=true" in final_plan(asof.asof_join(wide, prices, "key", "day", "since", ["v"], "quarter"))
    # Against a side that is already partitioned by the key.
    newest = ranks.top_one(wide.select("key", "day"), ["key"], [F.col("day")]).withColumnRenamed("day", "first_day")
    assert "skew=true" in final_plan(joins.left_join_spread(wide, newest, "key", ["first_day"]))
    assert "skew=true" in final_plan(joins.semi_join_spread(wide, newest, "key"))
    assert "skew=true" in final_plan(checks.relationships(wide, "key", newest, "key"))
    # Rows of a hot id are gone before the shuffle that all others take.
    unique = collisions.rows_with_unique_key(wide, "key", hot_rows=1000)
    plan = final_plan(unique)
    plan = plan[: plan.index("Initial Plan")]
    assert plan.index("SortMergeJoin [key#") < plan.index("Exchange hashpartitioning(key#") < plan.index("BroadcastHashJoin [key#")
    assert unique.count() == 40000


def brute_asof(left, right):
    series = defaultdict(list)
    for key, at, value in right:
        if key is not None and at is not None:
            series[key].append((at, value))
    for known in series.values():
        known.sort()
    out = []
    for key, at, id_ in left:
        known = series.get(key, []) if at is not None else []
        place = bisect_right([k[0] for k in known], at) if known else 0
        out.append((key, at, id_, *(known[place - 1] if place else (None, None))))
    return out


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_j5_both_forms_equal_brute_force(spark, kind, seed):
    rng = random.Random(seed)

    def moment():
        if kind == "date":
            return date(2025, 12, 1) + timedelta(days=rng.randrange(400))
        return datetime(2025, 12, 1) + timedelta(hours=rng.randrange(400 * 24))

    keys = ["a", "b", "c", "only left", None]
    left = [(rng.choice(keys), moment() if rng.random() > 0.05 else None, i) for i in range(500)]
    right = list({(k, m): (k, m, rng.random()) for k, m in ((rng.choice(["a", "b", "c", "only right", None]), moment()) for _ in range(60))}.values())
    ldf = spark.createDataFrame(left, f"key string, at {kind}, id int")
    rdf = spark.createDataFrame(right, f"key string, since {kind}, value double")
    expected = sorted(brute_asof(left, right), key=lambda r: r[2])
    for period in ("week", "month", "quarter", "year"):
        got = asof.asof_join(ldf, rdf, "key", "at", "since", ["since", "value"], period)
        assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[2]) == expected
    got = asof.asof_join_sorted(ldf, rdf, "key", "at", "since", ["since", "value"])
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[2]) == expected


def test_j5_edges(spark):
    prices = spark.createDataFrame([("a", date(2026, 1, 31), 1.0), ("a", date(2026, 2, 1), 2.0)], "k string, d date, v double")
    asked = [date(2026, 1, 30), date(2026, 1, 31), date(2026, 2, 1), date(2099, 1, 1)]
    left = spark.createDataFrame([("a", d) for d in asked], "k string, at date")
    for form in (asof.asof_join, asof.asof_join_sorted):
        assert [r.v for r in form(left, prices, "k", "at", "d", ["v"]).orderBy("at").collect()] == [None, 1.0, 2.0, 2.0]
        assert form(left.limit(0), prices, "k", "at", "d", ["v"]).count() == 0
        assert form(left, prices.limit(0), "k", "at", "d", ["v"]).count() == 4


def test_j5_with_itself(spark):
    df = spark.createDataFrame([("a", date(2026, 1, d), float(d)) for d in (1, 5, 9)], "k string, d date, v double")
    for form in (asof.asof_join, asof.asof_join_sorted):
        got = form(df.select("k", "d"), df, "k", "d", "d", ["v"])
        assert [r.v for r in got.orderBy("d").collect()] == [1.0, 5.0, 9.0]


def test_j3_sparse_key(spark):
    left = spark.createDataFrame([(i, f"c{i}" if i % 4 == 0 else None) for i in range(200)], "id int, claim_id string")
    right = spark.createDataFrame([(f"c{i}", i) for i in range(0, 100, 8)] + [("n0", -1), ("kc0", -3), (None, -2)], "claim_id string, v int")
    got = joins.left_join_spread(left, right, "claim_id", ["v"])
    assert rows(got.select("id", "v", "_matched")) == sorted(
        ((i, i if i % 8 == 0 and i < 100 else None, i % 8 == 0 and i < 100) for i in range(200)),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_j5_no_task_holds_a_whole_history_of_timestamps(spark):
    prices = spark.createDataFrame([("a", datetime(2026, 1, 1), 1.0)], "k string, d timestamp_ntz, v double")
    plan = plan_of(asof.validity_intervals(prices, "k", "d"))
    plan += plan_of(asof.asof_join_sorted(prices.select("k", "d"), prices, "k", "d", "d", ["v"]))
    row_windows = [line for line in plan.splitlines() if " Window [" in line and ("lead(d#" in line or "last(_row#" in line)]
    assert len(row_windows) == 2 and all("_day#" in line for line in row_windows)



def test_p3_history(spark):
    days = [date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1), date(2026, 4, 1)]
    terms = {"a": [50.0, 50.0, 80.0, 50.0], "b": [None, None, 0.0, 0.0], "c": [1.0, 1.0, 1.0, 1.0]}
    versions = [(k, d, v) for k, values in terms.items() for d, v in zip(days, values)]
    built = scd2.build_history(spark.createDataFrame(versions, "k string, d date, v double"), "k", "d", ["v"])
    assert rows(built.orderBy("k", "valid_from")) == sorted(
        [
            ("a", 50.0, days[0], days[2], False),
            ("a", 80.0, days[2], days[3], False),
            ("a", 50.0, days[3], None, True),
            ("b", None, days[0], days[2], False),
            ("b", 0.0, days[2], None, True),
            ("c", 1.0, days[0], None, True),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert rows(scd2.current_rows(built)) == [("a", 50.0), ("b", 0.0), ("c", 1.0)]
    asked = spark.createDataFrame([("a", date(2026, 2, 28)), ("a", date(2026, 3, 1)), ("z", days[0]), (None, days[0])], "k string, at date")
    joined = asof.join_validity(asked, built, "k", "at", "valid_from", "valid_to", ["v"])
    assert rows(joined) == [("a", date(2026, 2, 28), 50.0), ("a", date(2026, 3, 1), 80.0), ("z", days[0], None), (None, days[0], None)]


def test_p3_absent_and_hot_keys_are_spread(spark, small_sizes):
    """Nine rows in ten have no key: no task gets most of them, and every row keeps its answer."""
    asked = spark.range(0, 40000, 1, 8).select(
        "id",
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("p"), (F.col("id") % 4).cast("string"))).alias("k"),
        F.expr("date'2026-01-01' + cast(id % 80 as int)").alias("at"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    turn = date(2026, 2, 1)
    terms = [("p0", date(2025, 1, 1), turn, 1.0), ("p0", turn, None, 2.0), ("p1", turn, None, 3.0), (None, turn, None, 9.0)]
    history = spark.createDataFrame(terms, "k string, valid_from date, valid_to date, v double")
    joined = asof.join_validity(asked, history, "k", "at", "valid_from", "valid_to", ["v"])
    sizes = [r["count"] for r in joined.select("payload", "v", F.spark_partition_id().alias("task")).groupBy("task").count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 20000
    assert joined.columns == [*asked.columns, "v"]
    for r in joined.collect():
        assert r.v == ((1.0 if r.at < turn else 2.0) if r.k == "p0" else None)
    hot = asked.withColumn("k", F.when(F.col("id") % 3 == 0, "p0").otherwise(F.col("id").cast("string")))
    assert "skew=true" in final_plan(asof.join_validity(hot, history, "k", "at", "valid_from", "valid_to", ["v"]))


def test_a8_quintiles_of_a_crowded_column(spark):
    rng = random.Random(7)
    data = [(5.0 if i % 3 == 0 else rng.choice([-2.5, 4.999, rng.random() * 1e6]), rng.random()) for i in range(900)]
    df = spark.createDataFrame(data, "price double, fee double")
    prices = sorted(p for p, _ in data)
    groups = defaultdict(list)
    for price, fee in data:
        groups[5 * prices.index(price) // len(prices) + 1].append((price, fee))
    got = profile.quantile_profile(df, "price", "fee").orderBy("quantile").collect()
    assert [(r.quantile, r.n_rows, r.min_price, r.max_price) for r in got] == [
        (q, len(g), min(g)[0], max(g)[0]) for q, g in sorted(groups.items())
    ]
    for r in got:
        assert r.avg_fee == pytest.approx(sum(f for _, f in groups[r.quantile]) / r.n_rows)


def test_a9_shares(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 1.0), (None, 0.0)], "g string, m double")
    assert rows(profile.share_of_total(df, ["g"], "m")) == [
        ("x", 2, 3.0, 0.5, 0.75), ("y", 1, 1.0, 0.25, 0.25), (None, 1, 0.0, 0.25, 0.0)
    ]


def test_t1_to_t5(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert rows(checks.unique(df, "k")) == [("a", 2)]
    assert rows(checks.not_null(df, "k")) == [(None, 1), (None, 1)]
    assert rows(checks.relationships(df, "k", parent, "id")) == [("b", 1)]
    assert rows(checks.accepted_values(df, "k", ["a"])) == [("b", 1)]
    assert rows(checks.unique_combination(df, ["k", "v"])) == [(None, 1, 2)]


def test_j5_prices_are_not_broadcast(spark):
    """The size that Spark guesses for the right side knows nothing of the ranges that are made of its rows."""
    days = spark.range(3).select(F.lit("a").alias("k"), F.expr("date_add(date'2026-01-01', cast(id as int))").alias("d"), "id")
    got = asof.asof_join(days.select("k", "d"), days, "k", "d", "d", ["id"], "quarter")
    assert "BroadcastExchange" not in plan_of(got)
    assert rows(got.select("id")) == [(0,), (1,), (2,)]


def test_l1_sizes_are_not_made_for_their_sum(spark, tmp_path):
    spark.range(100).select((F.col("id") % 90).alias("key"), "id").write.parquet(str(tmp_path / "rows"))
    unique = collisions.rows_with_unique_key(spark.read.parquet(str(tmp_path / "rows")), "key", hot_rows=1)
    assert len(rows(unique)) == 80
    assert "sum(_n" not in plan_of(unique)
