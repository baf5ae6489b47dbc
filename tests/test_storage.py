"""K4 and P4: facts in periods and buckets, and refreshes that are published whole or not at all."""

from datetime import date

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from test_warehouse import landed, small, split  # noqa: F401

from ledgerlake.plans import gold, incremental, publication, storage, warehouse
from ledgerlake.session import scratch_dir


@pytest.fixture
def database(spark):
    path = scratch_dir(spark, "db")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def side_of(plan: str, scan: str) -> list[str]:
    """The operators between a scan and the first join above it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, above = lines[at].index("FileScan"), []
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            above.append(line.strip(" :+-"))
            if "Join" in line:
                break
    return above


@pytest.mark.parametrize("hot_rows", [100_000, 1])
def test_lookup_fact_by_bucket(spark, small, database, hot_rows):  # noqa: F811
    """The stored claims are scanned by bucket and not moved; rows are those of the plain form, hot claims or not."""
    incremental.store_fct_claim(small.fct_claim, f"{database}.fct_claim", "month", buckets=8)
    stored = spark.table(f"{database}.fct_claim")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fct_lookup_by_bucket(small.slv_lookups, stored, hot_rows)
        plan = plan_of(fact)
        above = side_of(plan, f"{database}/fct_claim" if f"{database}/fct_claim" in plan else "Bucketed: true")
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above)
        assert "SelectedBucketsCount: 8 out of 8" in plan
        found = rows(fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == rows(small.fct_lookup)


def test_periods_are_pruned_and_rows_without_a_key_are_spread(spark, small, database):  # noqa: F811
    layout = storage.Layout("lookup_id", buckets=4)
    table = f"{database}.lookups"
    storage.save(small.fct_lookup, table, layout=layout)
    stored = spark.table(table)
    assert rows(stored.drop(storage.PERIOD)) == rows(small.fct_lookup)
    some = stored.select(storage.PERIOD).first()[0]
    assert f"PartitionFilters: [isnotnull({storage.PERIOD}" in plan_of(stored.filter(F.col(storage.PERIOD) == F.lit(some)))
    # Without coalescing, as with large data, a period's rows without a key are written by several tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = storage.arranged(small.fct_lookup.filter("claim_id IS NULL"), layout).groupBy(storage.PERIOD, F.spark_partition_id().alias("task")).count()
        per_period = [r[0] for r in tasks.groupBy(storage.PERIOD).agg(F.count("*")).select("count(1)").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(per_period) > 1


@pytest.mark.parametrize("cutoff", ["2026-03-02", "2026-03-12"])
def test_p4_refresh_of_bucketed_facts(spark, landed, database, cutoff):  # noqa: F811
    known, fresh = split(landed, cutoff)
    before, after = warehouse.Warehouse(known), warehouse.Warehouse(landed)
    claims, lookups = f"{database}.fct_claim", f"{database}.fct_lookup"
    for table, fact in ((claims, before.fct_claim), (lookups, before.fct_lookup)):
        incremental.store_fct_claim(fact, table, "day", buckets=4)
    for _ in range(2):
        incremental.refresh_fct_claim(spark, claims, known, fresh, "day", lookup_table=lookups)
        assert storage.buckets_of(spark, claims) == 4
        assert rows(spark.table(claims).select(*after.fct_claim.columns)) == rows(after.fct_claim)
        assert rows(spark.table(lookups).select(*after.fct_lookup.columns)) == rows(after.fct_lookup)


def materialized(spark, landed, folder, prefix, **options):  # noqa: F811
    return warehouse.materialize(spark, warehouse.Warehouse(landed), folder, prefix=prefix, **options)


def cleared(spark, prefix):
    for name in [d.name for d in spark.catalog.listDatabases(f"{prefix}*")]:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def fills(spark, prefix):
    return spark.sql(f"SELECT count(*) FROM {prefix}gold.fct_claim").first()[0]


def test_a_refresh_is_published_whole(spark, landed, tmp_path):  # noqa: F811
    folder = str(tmp_path)
    tables = materialized(spark, landed, folder, "whole_")
    assert "period_start" not in tables["fct_claim"].columns
    first = publication.releases(spark, folder)
    assert [r.number for r in first] == [1] and set(first[0].tables) == {f"gold.{n}" for n in tables if n in warehouse.LAYERS["gold"]}
    before = fills(spark, "whole_")
    fewer = {**landed, "claims": landed["claims"].filter("claim_id <> 'flat'")}
    materialized(spark, fewer, folder, "whole_")
    assert fills(spark, "whole_") == before - 1
    # The older release can still be read, and taken back into use.
    assert publication.open_release(spark, folder, "whole_", number=1)["gold.fct_claim"].count() == before
    assert fills(spark, "whole_") == before
    publication.open_release(spark, folder, "whole_")
    assert fills(spark, "whole_") == before - 1
    cleared(spark, "whole_")


@pytest.mark.parametrize("broken", ["fct_lookup", "gld_revenue_reconciliation"])
def test_a_failure_at_any_table_leaves_the_old_release(spark, landed, tmp_path, broken):  # noqa: F811
    prefix, folder = f"fail_{broken}_", str(tmp_path)
    materialized(spark, landed, folder, prefix)
    before = {n: rows(spark.table(f"{prefix}gold.{n}")) for n in ("fct_claim", "fct_lookup", "dim_pharmacy")}
    w = warehouse.Warehouse({**landed, "claims": landed["claims"].limit(2)})
    # A row that fails while the table is written, not while it is planned.
    setattr(w, broken, getattr(w, broken).withColumn("date_day", F.raise_error(F.lit("lost")).cast("date")))
    with pytest.raises(Exception, match="lost"):
        warehouse.materialize(spark, w, folder, prefix=prefix)
    assert {n: rows(spark.table(f"{prefix}gold.{n}")) for n in before} == before
    assert len(publication.releases(spark, folder)) == 1
    cleared(spark, prefix)


def test_a_failing_test_blocks_publication(spark, landed, tmp_path):  # noqa: F811
    folder = str(tmp_path)
    with pytest.raises(ValueError, match="snapshots loaded"):
        materialized(spark, landed, folder, "blocked_", test=True)
    assert publication.releases(spark, folder) == []
    assert not [t for t in spark.catalog.listTables("blocked_gold") if not t.isTemporary]
    with pytest.raises(publication.PublicationError, match="no release"):
        publication.open_release(spark, folder, "blocked_")
    cleared(spark, "blocked_")


def test_a_failure_while_names_move_is_healed(spark, landed, tmp_path, monkeypatch):  # noqa: F811
    folder = str(tmp_path)
    materialized(spark, landed, folder, "heal_")
    before = fills(spark, "heal_")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(publication, "_move_names", lost)
        with pytest.raises(RuntimeError, match="lost"):
            materialized(spark, {**landed, "claims": landed["claims"].filter("claim_id <> 'flat'")}, folder, "heal_")
    assert fills(spark, "heal_") == before  # the old release, whole
    publication.open_release(spark, folder, "heal_")
    assert fills(spark, "heal_") == before - 1
    cleared(spark, "heal_")


def test_two_refreshes_at_once_and_a_writer_that_died(spark, landed, tmp_path, monkeypatch):  # noqa: F811
    folder = str(tmp_path)
    materialized(spark, landed, folder, "two_")
    with monkeypatch.context() as m:
        m.setattr(publication, "_numbers", lambda *_: [])  # it looked before the other had published
        draft = publication.Draft(spark, folder, "two_")
        draft.write("gold", "dim_partner", warehouse.Warehouse(landed).dim_partner)
        with pytest.raises(publication.PublicationError, match="another refresh"):
            draft.publish()
    (tmp_path / "_manifests" / "000000000002.json").write_text('{"name": "cut of')
    assert [r.number for r in publication.releases(spark, folder)] == [1]
    materialized(spark, landed, folder, "two_")
    assert [r.number for r in publication.releases(spark, folder)] == [3, 1]
    cleared(spark, "two_")


def test_another_session_reads_the_release_by_its_manifest(spark, landed, tmp_path):  # noqa: F811
    """The catalog is empty, as in a new session: tables with their buckets and periods come from the manifest."""
    folder = str(tmp_path)
    want = rows(materialized(spark, landed, folder, "other_")["fct_claim"])
    cleared(spark, "other_")
    found = publication.open_release(spark, folder, "other_")
    fact = found["gold.fct_claim"]
    assert rows(fact.drop("period_start")) == want
    name = publication.releases(spark, folder)[0].tables["gold.fct_claim"]["table"]
    assert storage.buckets_of(spark, name) == storage.BUCKETS
    assert fact.filter(F.col("period_start") == F.lit(date(2026, 1, 1))).count() == sum(r[4].year == 2026 for r in want) > 0
    cleared(spark, "other_")


def test_retention(spark, landed, tmp_path):  # noqa: F811
    folder = str(tmp_path)
    for _ in range(3):
        materialized(spark, landed, folder, "keep_")
    young = publication.Draft(spark, folder, "keep_")
    young.write("gold", "dim_partner", warehouse.Warehouse(landed).dim_partner)
    names = [r.name for r in publication.releases(spark, folder)]
    assert publication.retire(spark, folder, keep=2) == [names[2]]
    assert [r.name for r in publication.releases(spark, folder)] == names[:2]
    folders = {p.name for p in (tmp_path / "_releases").iterdir()}
    assert folders == {*names[:2], young.release.name}  # it may still be at work
    assert publication.retire(spark, folder, keep=2, grace_hours=0) == [young.release.name]
    materialized(spark, landed, folder, "keep_", keep=1)
    assert len(publication.releases(spark, folder)) == 1 and len(list((tmp_path / "_releases").iterdir())) == 1
    assert fills(spark, "keep_") > 0
    with pytest.raises(ValueError, match="must be kept"):
        publication.retire(spark, folder, keep=0)
    cleared(spark, "keep_")
