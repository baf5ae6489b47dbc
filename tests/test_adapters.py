"""The benchmark tables as landed tables: work is dealt over tasks by the size of the files."""

from datetime import datetime

from conftest import plan_of, rows
from pyspark.sql import functions as F

import benchmark_queries
from ledgerlake import adapters


def test_prices_are_made_by_tasks_that_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters.spread_rows, "__defaults__", (512,))
    folder = str(tmp_path)
    part = spark.range(200).select(
        F.when(F.col("id") != 5, F.col("id")).alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"),
        F.lit("PROMO").alias("p_type"), F.lit(3).alias("p_size"), F.lit(2.0).alias("p_retailprice"),
    )
    part.coalesce(1).write.parquet(f"{folder}/part.parquet")
    days = [(k, k, "O", 1.0, datetime(1996 + k, 5, 1), "x") for k in range(2)]
    spark.createDataFrame(days, adapters.SCHEMAS["orders"]).write.parquet(f"{folder}/orders.parquet")
    prices = adapters.nadac(spark, folder)
    assert prices.rdd.getNumPartitions() > 1
    want = sorted((str(k), f"{1996 + y}-04-01") for k in range(200) if k % 17 and k != 5 for y in range(2))
    assert rows(prices.select("ndc", F.col("as_of_date").cast("string"))) == want


def test_files_of_suppliers_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    suppliers = spark.range(4000).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), "id").alias("s_name"), F.lit(1).alias("s_nationkey"), F.rand(1).alias("s_acctbal")
    )
    suppliers.coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    b = benchmark_queries.Bench(spark, folder)
    dealt = adapters.spread_rows(b.table("supplier"), "s_suppkey", folder, "supplier", share=4 << 10)
    assert dealt.rdd.getNumPartitions() > 4 and rows(dealt) == rows(b.table("supplier"))


def test_both_policies_share_the_flagged_claims(spark, sf_dir):
    plan = benchmark_queries.QUERIES["l1_collision_policy"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_a_stream_builds_each_side_once(spark, sf_dir, monkeypatch):
    want = rows(benchmark_queries.Bench(spark, sf_dir).slv_claims.select("claim_id"))
    # What ends the streams comes from their folders.
    monkeypatch.setattr(benchmark_queries.Bench, "slv_reverts", property(lambda self: 1 / 0))
    got = benchmark_queries.QUERIES["st2_earliest_revert"](spark, sf_dir)
    assert rows(got.select("claim_id")) == want


def test_customers_of_lookups_are_not_broadcast(spark, sf_dir):
    """The size that Spark guesses from compressed files is far below that of the rows."""
    lookups = adapters.lookups(spark, sf_dir)
    assert "BroadcastExchange" not in plan_of(lookups)
    assert lookups.count() == adapters.table(spark, sf_dir, "orders").count()
