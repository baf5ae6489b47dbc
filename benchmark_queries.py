"""Every registered query next to the SQL that must give the same rows.

Queries run over whole benchmark tables. ``add`` takes the key, a function of ``Bench`` and the SQL;
a query without SQL has none that could express it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import adapters
from ledgerlake.functions import dates, money, parsing
from ledgerlake.operators import asof, checks, profile, scd2
from ledgerlake.operators.quarantine import CONTRACTS, bad_timestamp, clean_rows, missing_fields, non_numeric
from ledgerlake.operators.ranks import group_sizes, number_rows, top_one
from ledgerlake.plans import assertions, gold, incremental, marts, metrics, publication, reports, silver, storage, suite, warehouse
from ledgerlake.session import scratch_dir, stage, tune
from ledgerlake.sources import events, landing, reference
from ledgerlake.streaming.quarantine_stream import start_quarantine
from ledgerlake.streaming.revert_join import claims_with_earliest_revert, claims_with_reverts
from oracle_queries import NUMBER, ratio, statement, total

CHAIN = "asia"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Bench(warehouse.Warehouse):
    """The layers over the benchmark tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, policies: warehouse.Policies = warehouse.Policies()) -> None:
        tune(spark)
        super().__init__(adapters.Landing(spark, sf_dir), policies)
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, name)

    def judged(self, stream: str, load: str | None = None) -> DataFrame:
        return adapters.judged(self.spark, self.sf_dir, stream, load)

    def clean(self, stream: str) -> DataFrame:
        return clean_rows(self.judged(stream), CONTRACTS[stream])

    def under(self, **policies: str) -> Bench:
        return Bench(self.spark, self.sf_dir, warehouse.Policies(**policies))

    def scratch(self, name: str) -> str:
        return scratch_dir(self.spark, name)

    def json_folder(self, stream: str) -> str:
        folder = self.scratch(f"json-{stream}")
        adapters.write_json_files(adapters.RAW_STREAMS[stream](self.spark, self.sf_dir), folder)
        return folder

    def csv_folder(self, name: str, rows: DataFrame) -> str:
        folder = self.scratch(f"csv-{name}")
        rows.write.option("header", True).option("escape", '"').csv(folder)
        return folder


def add(name: str, run: Callable[[Bench], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: run(Bench(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = statement(sql)


def stacked(**tables: DataFrame) -> DataFrame:
    """Tables of one shape under each other, named in the column ``part``."""
    return reduce(DataFrame.unionByName, [t.withColumn("part", F.lit(name)) for name, t in tables.items()])


def rows(name: str = "n_rows") -> Column:
    return F.count(F.lit(1)).alias(name)


# --- S: sources -------------------------------------------------------------------------------


def s1(b: Bench, **options: int) -> DataFrame:
    records = events.read_json_dir(b.spark, b.json_folder("claims"), "*.txt", **options)
    field = F.from_json("raw_payload", "id string, npi string, ndc string, price string, timestamp string")
    return records.select(field.alias("r"), "source_file", "reject_reason").select(
        "r.id", "r.npi", "r.ndc", F.try_to_number("r.price", F.lit("S999999999.99")).cast("double").alias("price"),
        F.col("r.timestamp").alias("event_time"), "reject_reason", F.col("source_file").endswith(".txt").alias("named"),
    )


S1_SQL = """select json_extract_string(raw_payload, '$.id') as id, json_extract_string(raw_payload, '$.npi') as npi,
              json_extract_string(raw_payload, '$.ndc') as ndc,
              try_cast(json_extract_string(raw_payload, '$.price') as double) as price,
              json_extract_string(raw_payload, '$.timestamp') as event_time, cast(null as varchar) as reject_reason,
              true as named
       from raw_claims"""
add("s1_json_dir", s1, S1_SQL)
# Every array is read in chunks.
add("s1_split_arrays", lambda b: s1(b, split_above=1), S1_SQL)


def s2(b: Bench) -> DataFrame:
    kept = b.table("customer").select("c_custkey", "c_name", "c_nationkey", F.lit('5" pipe, long').alias("remark"))
    return reference.read_csv_dir(b.spark, b.csv_folder("customers", kept))


add(
    "s2_csv_dir",
    s2,
    """select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
              '5" pipe, long' as remark
       from customer""",
)


def supplier_rows(b: Bench) -> DataFrame:
    key = F.col("s_suppkey")
    npi = F.when(key % 9 == 0, "").otherwise(F.concat(F.lit(" "), key.cast("string"), F.lit("\t")))
    return b.table("supplier").select(
        npi.alias("npi"), F.when(key % 4 != 0, F.concat(F.lit(" "), "s_name", F.lit(" "))).alias("chain")
    )


add(
    "s3_pharmacies_source",
    lambda b: reference.pharmacies(b.spark, b.csv_folder("pharmacies", supplier_rows(b)), "load-7"),
    """select cast(s_suppkey as varchar) as npi, case when s_suppkey % 4 <> 0 then s_name else '' end as chain,
              'load-7' as load_id
       from supplier where s_suppkey % 9 <> 0""",
)


def customer_terms(b: Bench) -> DataFrame:
    key = F.col("c_custkey")
    cents = F.when(key % 5 == 0, "0").when(key % 5 == 1, " 25 ").when(key % 5 == 2, "n/a").when(key % 5 == 3, "1e2")
    share = F.when(key % 3 == 0, "12.5").when(key % 3 == 1, "0x1p3")
    return b.table("customer").select(
        F.when(key % 11 != 0, F.concat("c_name", F.lit(" "))).alias("partner"),
        cents.alias("fee_cents"),
        share.alias("fee_percentage"),
    )


add(
    "s4_partners_source",
    lambda b: reference.partners(b.spark, b.csv_folder("partners", customer_terms(b)), "load-7"),
    """select c_name as partner,
              case c_custkey % 5 when 0 then 0.0::double when 1 then 25.0 when 3 then 100.0 end as fee_cents,
              case c_custkey % 3 when 0 then 12.5::double end as fee_percentage, 'load-7' as load_id
       from customer where c_custkey % 11 <> 0""",
)


def price_file_rows(b: Bench) -> DataFrame:
    """The price series as published: twelve columns, some costs and dates unreadable."""
    key = F.col("ndc").cast("bigint")
    us_date = F.date_format("as_of_date", "M/d/yyyy")
    return b.landing["nadac"].select(
        F.col("ndc_description").alias("NDC Description"),
        F.concat(F.col("ndc"), F.lit(" ")).alias("NDC"),
        F.when(key % 13 == 0, "n/a").otherwise(F.col("nadac_per_unit").cast("string")).alias("NADAC Per Unit"),
        us_date.alias("Effective Date"),
        F.lit("EA").alias("Pricing Unit"),
        F.lit("C/I").alias("Pharmacy Type Indicator"),
        F.when(F.col("is_otc"), "y").otherwise("N").alias("OTC"),
        F.lit("1").alias("Explanation Code"),
        F.col("rate_setting_class").alias("Classification for Rate Setting"),
        F.lit("").alias("Corresponding Generic Drug NADAC Per Unit"),
        F.lit("").alias("Corresponding Generic Drug Effective Date"),
        F.when(key % 10 == 0, "13/45/2001").otherwise(us_date).alias("As of Date"),
    )


add(
    "s5_price_source",
    lambda b: reference.prices(b.spark, b.csv_folder("prices", price_file_rows(b)), "load-7"),
    """select ndc, ndc_description, nadac_per_unit, effective_date,
              case when cast(ndc as bigint) % 10 <> 0 then as_of_date end as as_of_date, pricing_unit,
              rate_setting_class, is_otc, 'load-7' as load_id
       from nadac where cast(ndc as bigint) % 13 <> 0""",
)


def s6(b: Bench) -> DataFrame:
    paths = {s: b.json_folder(s) for s in ("claims", "reverts")}
    paths["pharmacies"] = b.csv_folder("pharmacies", supplier_rows(b))
    loaded = landing.ingest(b.spark, paths, b.scratch("landing"), "load-7", {"claims", "pharmacies"}, "*.txt")
    return stacked(**{name: t.groupBy("load_id").agg(rows()) for name, t in loaded.items()})


add(
    "s6_ingest_subset",
    s6,
    """select 'load-7' as load_id, case when reject_reason is null then 'claims' else 'claims_rejects' end as part,
              count(*) as n_rows from judged_claims group by 2
       union all select 'load-7', 'pharmacies', count(*) from supplier where s_suppkey % 9 <> 0""",
)

# --- K: sinks ---------------------------------------------------------------------------------


def k1(b: Bench) -> DataFrame:
    target = b.scratch("lookups")
    b.landing["lookups"].filter("claim_id IS NULL").write.mode("overwrite").parquet(target)
    b.landing["lookups"].write.mode("overwrite").parquet(target)
    return b.spark.read.parquet(target)


add("k1_full_refresh", k1, "select * from lookups")


def k2(b: Bench) -> DataFrame:
    target = b.scratch("claims")
    landing.write_quarantine(b.judged("claims"), target)
    stored = landing.read_quarantine(b.spark, target, "claims")
    shape = ["claim_id", "npi", "price", "filled_at", "raw_payload", "reject_reason", "source_file"]
    padded = {
        name: t.select(*[F.col(c) if c in t.columns else F.lit(None).alias(c) for c in shape])
        for name, t in stored.items()
    }
    return stacked(**padded)


add(
    "k2_quarantine_routing",
    k2,
    """select claim_id, npi, price, filled_at, cast(null as varchar) as raw_payload, reject_reason, source_file,
              'claims' as part from judged_claims where reject_reason is null
       union all
       select null, null, null, null, raw_payload, reject_reason, source_file, 'claims_rejects'
       from judged_claims where reject_reason is not null""",
)


def k3(b: Bench) -> DataFrame:
    stamped = events.validated_stream(b.spark, b.json_folder("reverts"), "reverts", "load-9", "*.txt")
    return stamped.select(
        "revert_id", "reject_reason", "load_id", F.col("source_file").rlike(r"^part-.*\.txt$").alias("has_file")
    )


add(
    "k3_lineage",
    k3,
    "select revert_id, reject_reason, 'load-9' as load_id, true as has_file from judged_reverts",
)


def k4(b: Bench) -> DataFrame:
    prefix = f"k4_{uuid.uuid4().hex}_"
    warehouse.materialize(b.spark, b, b.scratch("layers"), prefix=prefix)
    names = {
        name: f"{prefix}gold.{name}" if layer == "gold" else name
        for layer, tables in warehouse.LAYERS.items()
        for name in tables
    }
    counts = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in names.items())
    return b.spark.sql(counts)


add(
    "k4_layers",
    k4,
    "\nunion all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {name}"
        for layer in warehouse.LAYERS.values()
        for name in layer
    ),
)


def stored_claims(b: Bench) -> DataFrame:
    """The claim fact by month and in buckets, in a database of its own."""
    database = f"k4_{uuid.uuid4().hex}"
    b.spark.sql(f"CREATE DATABASE {database} LOCATION '{b.scratch('stored')}'")
    incremental.store_fct_claim(b.fct_claim, f"{database}.fct_claim", "year", buckets=8)
    return b.spark.table(f"{database}.fct_claim")


add(
    "k4_lookup_fact_by_bucket",
    lambda b: gold.fct_lookup_by_bucket(b.slv_lookups, stored_claims(b)),
    "select * from fct_lookup",
)


def k4_release(b: Bench) -> DataFrame:
    """Two releases in one folder; the first is removed, and the second is read as its manifest has it."""
    folder, prefix = b.scratch("releases"), f"r_{uuid.uuid4().hex}_"
    for _ in range(2):
        again = Bench(b.spark, b.sf_dir)
        warehouse.materialize(b.spark, again, folder, prefix=prefix, keep=1)
    found = publication.open_release(b.spark, folder, prefix)
    fact = found["gold.fct_claim"]
    years = fact.groupBy(storage.PERIOD).agg(rows("fills"), F.sum("net_fills").cast("bigint").alias("net_fills"))
    return years.withColumn("releases", F.lit(len(publication.releases(b.spark, folder))).cast("bigint"))


add(
    "k4_published_release",
    k4_release,
    """select cast(date_trunc('year', date_day) as date) as period_start, count(*) as fills,
              cast(sum(net_fills) as bigint) as net_fills, cast(1 as bigint) as releases
       from fct_claim group by all""",
)

# --- V: record validation ---------------------------------------------------------------------


def field_struct(stream: str) -> Column:
    return F.from_json("raw_payload", ", ".join(f"`{name}` string" for name in CONTRACTS[stream].fields))


def v1(b: Bench) -> DataFrame:
    parsed = adapters.raw_lookups(b.spark, b.sf_dir).select(field_struct("lookups").alias("r"))
    return parsed.select("r.id", missing_fields(F.col("r"), CONTRACTS["lookups"].required).alias("reason"))


add(
    "v1_missing_fields",
    v1,
    """select lookup_id as id, case when reject_reason like 'missing%' then reject_reason end as reason
       from judged_lookups""",
)

TIME_TEXTS = [
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S')", "date_trunc('second', ts)"),
    ("strftime(ts, '%Y-%m-%d')", "date_trunc('day', ts)"),
    ("strftime(ts, '%Y-%m-%d %H:%M')", "date_trunc('minute', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')", "ts"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'", "date_trunc('second', ts)"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-05:30'", "date_trunc('second', ts) + interval 330 minute"),
    ("strftime(ts, '%Y')", "null"),
    ("' ' || strftime(ts, '%Y-%m-%d')", "null"),
    ("strftime(ts, '%Y/%m/%d %H:%M')", "null"),
    ("strftime(ts, '%Y') || '-02-30T08:00:00'", "null"),
    ("''", "null"),
    ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0200'", "date_trunc('second', ts) - interval 2 hour"),
]
SPARK_TIME_TEXTS = [
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "date_format(ts, 'yyyy-MM-dd')",
    "date_format(ts, 'yyyy-MM-dd HH:mm')",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z')",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '-05:30')",
    "date_format(ts, 'yyyy')",
    "concat(' ', date_format(ts, 'yyyy-MM-dd'))",
    "date_format(ts, 'yyyy/MM/dd HH:mm')",
    "concat(date_format(ts, 'yyyy'), '-02-30T08:00:00')",
    "''",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+0200')",
]


def choose(texts: list[str]) -> str:
    branches = " ".join(f"when event_id % {len(texts)} = {i} then {text}" for i, text in enumerate(texts))
    return f"case {branches} end"


def v2(b: Bench) -> DataFrame:
    texts = b.table("events").select("event_id", F.expr(choose(SPARK_TIME_TEXTS)).alias("text"))
    read = texts.withColumn("event_time", parsing.parse_iso_timestamp(F.col("text")))
    return read.withColumn("reason", bad_timestamp({"timestamp": F.col("event_time")}, ["timestamp"]))


V2_SQL = f"""
    with t as (select event_id, {choose([text for text, _ in TIME_TEXTS])} as text,
                      cast({choose([value for _, value in TIME_TEXTS])} as timestamp) as event_time from events)
    select *, case when event_time is null then 'unparseable_timestamp' end as reason from t"""
add("v2_timestamps", v2, V2_SQL)

NUMBER_TEXTS = ["'42.5d'", "'0x1p3'", "'NaN'", "'inf'", "'1_000'", "'true'", "' 12.5 '", "'1e3'", "'.5'", "'5.'",
                "'-3'", "'one'", "''"]


def v3(b: Bench) -> DataFrame:
    texts = b.table("events").select(
        "event_id", F.expr(choose(NUMBER_TEXTS)).alias("price_text"), F.col("event_type").alias("quantity_text")
    )
    typed = texts.withColumn("price", parsing.parse_number(F.col("price_text")))
    typed = typed.withColumn("quantity", parsing.parse_number(F.col("quantity_text")))
    judged = {name: F.col(name) for name in ("price", "quantity")}
    return typed.withColumn("reason", non_numeric(judged, ["price", "quantity"])).drop("quantity_text", "quantity")


add(
    "v3_numbers",
    v3,
    f"""with t as (select event_id, {choose(NUMBER_TEXTS)} as price_text from events),
            p as (select *, case when regexp_full_match(trim(price_text), '{NUMBER}')
                                 then cast(trim(price_text) as double) end as price from t)
        select *, case when price is null then 'non_numeric:price,quantity' else 'non_numeric:quantity' end as reason
        from p""",
)
add(
    "v4_claim_rules",
    lambda b: b.judged("claims").select("claim_id", "price", "quantity", "reject_reason"),
    "select claim_id, price, quantity, reject_reason from judged_claims",
)
add("v5_revert_rules", lambda b: b.judged("reverts"), "select * from judged_reverts")
add("v6_lookup_rules", lambda b: b.judged("lookups"), "select * from judged_lookups")
add(
    "v7_typed_projection",
    lambda b: b.clean("claims"),
    """select claim_id, npi, ndc, price, quantity, pbm_fee, filled_at from judged_claims where reject_reason is null""",
)
add(
    "x1_unreadable_files",
    lambda b: events.read_json_dir(b.spark, broken_files(b), "*.txt").groupBy("reject_reason").agg(rows()),
    """select case when s_suppkey % 7 = 0 then 'unreadable_file' end as reject_reason,
              sum(case when s_suppkey % 7 = 0 or s_suppkey % 5 = 0 then 1 else 2 end)::bigint as n_rows
       from supplier group by 1""",
)


def broken_files(b: Bench) -> str:
    """One file per supplier: an array of two objects, a single object, or text cut short."""
    key = F.col("s_suppkey")
    one = F.concat(F.lit('{"id":"'), key.cast("string"), F.lit('","chain":"a, {b} [c]"}'))
    two = F.concat(F.lit(' [\n "x", '), one, F.lit(", 5, ["), one, F.lit("],\n"), one, F.lit("]\n"))
    text = F.when(key % 7 == 0, F.expr("substr(t2, 1, length(t2) - 2)")).when(key % 5 == 0, F.col("t1")).otherwise(
        F.col("t2")
    )
    folder = b.scratch("broken")
    suppliers = adapters.spread_rows(b.table("supplier"), "s_suppkey", b.sf_dir, "supplier", share=4 << 10)
    files = suppliers.withColumn("t1", one).withColumn("t2", two).select(text.alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(folder)
    return folder


# --- B, L, G: the layers ----------------------------------------------------------------------

for number, name in enumerate(
    ["brz_claims", "brz_lookups", "brz_nadac", "brz_partners", "brz_pharmacies", "brz_rejects", "brz_reverts"], 1
):
    add(f"b{number}_{name}", lambda b, name=name: getattr(b, name), f"select * from {name}")


def both_policies(b: Bench) -> DataFrame:
    # Flagged once, for both.
    flagged = stage(b.brz_claims.drop("flag_duplicate_claim_id"), "flagged")
    return stacked(**{p: silver.resolved_claims(flagged, p) for p in ("quarantine_all", "keep_earliest")})


add(
    "l1_collision_policy",
    both_policies,
    """select * exclude (flag_duplicate_claim_id), 'quarantine_all' as part from unique_claims
       union all select * exclude (flag_duplicate_claim_id), 'keep_earliest' from earliest_claims""",
)
add("l2_slv_claims", lambda b: b.slv_claims, "select * from slv_claims")
add(
    "l2_slv_claims_keep_earliest",
    lambda b: b.under(duplicate_claims="keep_earliest").slv_claims,
    "select * from slv_claims_earliest",
)
add("l3_slv_lookups", lambda b: b.slv_lookups, "select * from slv_lookups")


def republished(b: Bench) -> DataFrame:
    """Each price twice: once more with an earlier effective date and another cost."""
    earlier = b.brz_nadac.withColumn("effective_date", F.date_sub("effective_date", 7)).withColumn(
        "nadac_per_unit", F.col("nadac_per_unit") * 2
    )
    return silver.slv_nadac(b.brz_nadac.unionByName(earlier))


add("l4_slv_nadac", republished, "select * from slv_nadac")
add("l5_slv_partners", lambda b: b.slv_partners, "select * from slv_partners")
add("l6_slv_pharmacies", lambda b: b.slv_pharmacies, "select * from slv_pharmacies")
add("l7_slv_reverts", lambda b: b.slv_reverts, "select * from slv_reverts")
add("l8_costs_as_of_fill", lambda b: b.slv_claim_costs, "select * from slv_claim_costs")
add(
    "l9_costs_latest",
    lambda b: b.under(cost_basis="latest").slv_claim_costs,
    "select * from slv_claim_costs_latest",
)
add("l10_converting_lookups", lambda b: silver.converting_lookups(b.slv_lookups), "select * from converting")


def attributed(b: Bench) -> DataFrame:
    return silver.attribute(b.slv_claim_costs, b.slv_lookups, b.slv_partners, b.slv_reverts)


add("l11_attributed_claims", attributed, "select * from attributed")
add(
    "l12_priced_claims",
    lambda b: silver.price_out(silver.split_fees(attributed(b))).select(
        "claim_id", "is_reverted", "drug_cost", "unit_price", "partner_fee"
    ),
    "select claim_id, is_reverted, drug_cost, unit_price, partner_fee::double as partner_fee from priced",
)
add("l13_claim_economics", lambda b: b.slv_claim_economics, "select * from slv_claim_economics")
for number, name in enumerate(["dim_date", "dim_drug", "dim_partner", "dim_pharmacy", "fct_claim", "fct_lookup"], 1):
    add(f"g{number}_{name}", lambda b, name=name: getattr(b, name), f"select * from {name}")

# --- J: joins ---------------------------------------------------------------------------------

add(
    "j1_inner_scope",
    lambda b: b.brz_claims.join(b.slv_pharmacies, "npi").groupBy("npi", "chain").agg(rows()),
    "select npi, chain, count(*) as n_rows from claims join slv_pharmacies using (npi) group by all",
)
add(
    "j2_inner_fact_dimension",
    lambda b: b.fct_claim.join(b.dim_drug.select("ndc", "ndc_description"), "ndc").select(
        "claim_id", "ndc", "ndc_description", "net_revenue"
    ),
    "select claim_id, ndc, ndc_description, net_revenue from fct_claim join dim_drug using (ndc)",
)
add(
    "j3_left_enrich",
    lambda b: b.landing["lookups"].join(b.slv_partners, "partner", "left").select(
        "lookup_id", "partner", "fee_type", "fee_cents"
    ),
    "select lookup_id, partner, fee_type, fee_cents from lookups left join slv_partners using (partner)",
)
add(
    "j4_anti",
    lambda b: b.landing["claims"].join(b.slv_pharmacies, "npi", "left_anti").select("claim_id", "npi", "ndc"),
    "select claim_id, npi, ndc from claims where npi not in (select npi from slv_pharmacies)",
)
ASOF_SQL = """
    select c.claim_id, c.ndc, c.filled_at, n.as_of_date, n.nadac_per_unit
    from claims c asof left join nadac n on n.ndc = c.ndc and n.as_of_date <= c.filled_at"""


def dated_claims(b: Bench) -> DataFrame:
    return b.landing["claims"].select("claim_id", "ndc", "filled_at")


add(
    "j5a_asof_interval",
    lambda b: asof.asof_join(
        dated_claims(b), b.landing["nadac"], "ndc", "filled_at", "as_of_date", ["as_of_date", "nadac_per_unit"], "quarter"
    ),
    ASOF_SQL,
)
add(
    "j5b_asof_sorted",
    lambda b: asof.asof_join_sorted(
        dated_claims(b),
        b.landing["nadac"].withColumn("at", F.col("as_of_date").cast("timestamp_ntz")),
        "ndc",
        "filled_at",
        "at",
        ["as_of_date", "nadac_per_unit"],
    ),
    ASOF_SQL,
)
add(
    "j6_semi",
    lambda b: b.landing["reverts"].join(b.slv_claims.select("claim_id"), "claim_id", "left_semi").select("revert_id"),
    "select revert_id from reverts where claim_id in (select claim_id from slv_claims)",
)
add(
    "j7_counts_side_by_side",
    lambda b: assertions.reconciliation(b.brz_claims, b.resolved_claims, b.slv_claims, b.slv_pharmacies),
    """select (select count(*) from brz_claims) as bronze_rows, (select count(*) from slv_claims) as silver_rows,
              (select count(*) from brz_claims where flag_duplicate_claim_id) as duplicate_rows,
              (select count(*) from unique_claims where npi not in (select npi from slv_pharmacies)) as out_of_scope_rows""",
)
add(
    "j8_series_per_row",
    lambda b: b.slv_reverts.join(b.slv_claims.select("claim_id", "filled_date"), "claim_id").select(
        "claim_id", F.explode(F.sequence("filled_date", "reverted_date", F.expr("INTERVAL 1 DAY"))).alias("open_day")
    ),
    """select claim_id, unnest(generate_series(filled_date, reverted_date, interval 1 day))::date as open_day
       from slv_reverts join slv_claims using (claim_id)""",
)
add(
    "j9_scalar_subquery",
    lambda b: b.slv_claims.groupBy("chain").agg(
        F.max("filled_date").alias("last_fill"),
    ).withColumn("last_lookup", b.landing["lookups"].agg(F.to_date(F.max("looked_up_at"))).scalar()),
    """select chain, max(filled_date) as last_fill, (select max(looked_up_date) from slv_lookups) as last_lookup
       from slv_claims group by chain""",
)

# --- A: aggregates, W: windows, O: order, SO: sets ----------------------------------------------

add(
    "a1_grouped",
    lambda b: b.fee_fact.groupBy("partner", "channel", "chain").agg(
        rows(),
        money.round_total(F.sum("price")).alias("revenue"),
        money.round_ratio(F.avg("quantity"), 4).alias("avg_quantity"),
    ),
    f"""select partner, channel, chain, count(*) as n_rows, {total('sum(price)')} as revenue,
               {ratio('avg(quantity)', 4)} as avg_quantity from fct_claim group by all""",
)
add(
    "a2_conditional_count",
    lambda b: b.brz_claims.groupBy("source_file").agg(
        money.count_true(F.col("flag_duplicate_claim_id")).alias("duplicates"),
        money.count_true(F.col("flag_fee_exceeds_price")).alias("fee_above_price"),
    ),
    """select source_file, count(*) filter (flag_duplicate_claim_id) as duplicates,
              count(*) filter (flag_fee_exceeds_price) as fee_above_price from brz_claims group by 1""",
)


def fee_share_of_large_sales(b: Bench) -> DataFrame:
    large = F.sum(F.when(F.col("quantity") > 45, F.col("price")).otherwise(0.0))
    share = money.round_ratio(money.percent(F.sum("pbm_fee"), large), 3)
    return b.landing["claims"].groupBy("ndc").agg(share.alias("pct"))


add(
    "a3_safe_ratio",
    fee_share_of_large_sales,
    f"""select ndc, {ratio("100.0 * sum(pbm_fee) / nullif(sum(case when quantity > 45 then price else 0 end), 0)", 3)} as pct
        from claims group by 1""",
)


def event_bounds(b: Bench) -> DataFrame:
    looked_up = F.to_date("looked_up_at")
    other = b.landing["lookups"].agg(F.struct(F.min(looked_up).alias("first"), F.max(looked_up).alias("last")))
    own = b.slv_claims.agg(F.min("filled_date").alias("first"), F.max("filled_date").alias("last"))
    return own.withColumn("other", other.scalar()).select(
        F.least("first", "other.first").alias("first"), F.greatest("last", "other.last").alias("last")
    )


add(
    "a4_bounds",
    event_bounds,
    "select min(date_day) as first, max(date_day) as last from days",
)
add(
    "a5_count_distinct",
    lambda b: b.landing["nadac"].agg(F.countDistinct("as_of_date").alias("dates"), F.countDistinct("ndc").alias("codes")),
    "select count(distinct as_of_date) as dates, count(distinct ndc) as codes from nadac",
)
add(
    "a6_having",
    lambda b: group_sizes(b.landing["claims"], ["claim_id"], "n_records").filter("n_records >= 3"),
    "select claim_id, count(*) as n_records from claims group by 1 having count(*) >= 3",
)
add(
    "a7_distinct",
    lambda b: b.fee_fact.select(F.round("partner_fee", 4).alias("fee"), "fee_type").filter("fee_type = 'flat'").distinct(),
    f"select distinct {ratio('partner_fee', 4)} as fee, fee_type from fct_claim where fee_type = 'flat'",
)
add(
    "a8_correlation",
    lambda b: profile.correlation(b.fee_fact, "pbm_fee", "price").select(F.round("correlation", 9).alias("correlation")),
    f"select {ratio('corr(pbm_fee, price)', 9)} as correlation from fct_claim",
)
add(
    "a8_fee_quintiles",
    lambda b: reports.fee_quintiles(b.fee_fact).withColumn("avg_pbm_fee", money.round_ratio(F.col("avg_pbm_fee"), 4)),
    f"""select (floor(5 * (r - 1) / n) + 1)::bigint as quantile, count(*) as n_rows, min(price) as min_price,
               max(price) as max_price, {ratio('avg(pbm_fee)', 4)} as avg_pbm_fee
        from (select *, rank() over (order by price) as r, count(*) over () as n from fct_claim) group by 1""",
)
add(
    "a9_share_of_total",
    lambda b: profile.share_of_total(b.fct_claim, ["is_generic"], "net_retained_margin")
    .withColumn("total", money.round_total(F.col("total")))
    .withColumn("share_of_rows", F.round("share_of_rows", 6))
    .withColumn("share_of_total", F.round("share_of_total", 6)),
    f"""select is_generic, count(*) as n_rows, {total('sum(net_retained_margin)')} as total,
               {ratio('count(*) / sum(count(*)) over ()', 6)} as share_of_rows,
               {ratio('sum(net_retained_margin) / sum(sum(net_retained_margin)) over ()', 6)} as share_of_total
        from fct_claim group by 1""",
)
add(
    "w1_count_per_key",
    lambda b: b.brz_reverts.select("revert_id", "claim_id", "flag_multiple_reverts"),
    "select revert_id, claim_id, count(*) over (partition by claim_id) > 1 as flag_multiple_reverts from reverts",
)
add(
    "w2_row_number",
    lambda b: number_rows(
        b.landing["claims"], "npi", "filled_at", ["claim_id", "ndc", "price"], "n", "n_all"
    ).select("npi", "claim_id", "ndc", "price", "n", "n_all"),
    """select npi, claim_id, ndc, price, row_number() over (partition by npi order by filled_at, claim_id, ndc, price) as n,
              count(*) over (partition by npi) as n_all from claims""",
)
add(
    "w3_first_per_group",
    lambda b: top_one(b.landing["lookups"], ["partner", "channel"], [F.col("looked_up_at"), F.col("lookup_id")]).select(
        "partner", "channel", "lookup_id", "looked_up_at"
    ),
    """select distinct on (partner, channel) partner, channel, lookup_id, looked_up_at from lookups
       order by partner, channel, looked_up_at, lookup_id""",
)
add(
    "w4_latest_per_group",
    lambda b: top_one(b.slv_nadac, ["ndc"], [F.col("as_of_date").desc_nulls_last()]),
    "select * from newest_prices",
)
add(
    "o1_sorted_report",
    lambda b: b.landing["claims"].groupBy("ndc").agg(rows(), money.round_total(F.sum("price")).alias("revenue"))
    .orderBy(F.col("revenue").desc_nulls_last()),
    f"select ndc, count(*) as n_rows, {total('sum(price)')} as revenue from claims group by 1 order by 3 desc",
)
add(
    "o2_sorted_by_two",
    lambda b: b.landing["lookups"].groupBy("partner", "claim_id").agg(rows()).orderBy(
        F.col("claim_id").asc_nulls_last(), F.col("n_rows").desc_nulls_last(), "partner"
    ),
    "select partner, claim_id, count(*) as n_rows from lookups group by 1, 2 order by 2, 3 desc, 1",
)
add(
    "o3_top_k",
    lambda b: b.fee_fact.select("claim_id", "price").orderBy(F.col("price").desc(), "claim_id").limit(25),
    "select claim_id, price from fct_claim order by price desc, claim_id limit 25",
)
add(
    "o4_preview",
    lambda b: reports.preview(b.fee_fact.select("claim_id", "price", "partner"), ["claim_id"]),
    """select claim_id, price, partner, (select count(*) from fct_claim) as full_count from fct_claim
       order by claim_id limit 200""",
)
add(
    "so1_union_all",
    lambda b: stacked(
        claims=b.landing["claims"].select("claim_id", F.col("filled_at").alias("at")),
        reverts=b.landing["reverts"].select("claim_id", F.col("reverted_at").alias("at")),
    ),
    """select claim_id, filled_at as at, 'claims' as part from claims
       union all select claim_id, reverted_at, 'reverts' from reverts""",
)
add("so2_union_distinct", lambda b: gold.observed_codes(b.slv_claims, b.slv_lookups), "select * from codes")

# --- C, D, JS, U: scalars -----------------------------------------------------------------------


def text_scalars(b: Bench) -> DataFrame:
    raw = F.col("channel")
    return b.landing["lookups"].select(
        "lookup_id",
        F.col("lookup_id").cast("double").alias("id_number"),
        F.col("looked_up_at").cast("date").alias("day"),
        F.col("claim_id").isNotNull().cast("int").alias("converts"),
        F.lower(F.trim(raw)).alias("lowered"),
        parsing.blank_to_null(raw).alias("no_blank"),
        F.coalesce(parsing.blank_to_null(raw), F.lit("none")).alias("filled"),
        (F.upper(F.trim("source_file")) == "O").alias("is_open"),
        parsing.parse_number(F.concat(raw, F.col("lookup_id"))).alias("maybe_number"),
    )


add(
    "c1_c2_c3_c4_c6_text_and_casts",
    text_scalars,
    """select lookup_id, cast(lookup_id as double) as id_number, cast(looked_up_at as date) as day,
              (claim_id is not null)::int as converts, lower(trim(channel)) as lowered,
              nullif(trim(channel), '') as no_blank, coalesce(nullif(trim(channel), ''), 'none') as filled,
              source_file = 'O' as is_open,
              case when trim(channel) = '' then cast(lookup_id as double) end as maybe_number
       from lookups""",
)


def number_scalars(b: Bench) -> DataFrame:
    price, quantity, fee = F.col("price"), F.col("quantity"), F.col("pbm_fee")
    return b.landing["claims"].select(
        "claim_id",
        "npi",
        "ndc",
        F.when(quantity >= 25, "large").when(quantity >= 10, "medium").otherwise("small").alias("size"),
        F.try_divide(price, F.nullif(quantity - 10, F.lit(0.0))).alias("guarded"),
        F.least(price, fee, F.lit(None)).alias("lower_of"),
        F.greatest(price, fee).alias("higher_of"),
        F.abs(fee - price).alias("gap"),
        money.round_ratio(price / 7, 2).alias("rounded"),
        ((quantity > 5) & ~quantity.isin(7.0, 8.0) | price.isNull()).alias("tested"),
    )


add(
    "c5_c7_c8_c9_c10_c11_arithmetic",
    number_scalars,
    f"""select claim_id, npi, ndc, case when quantity >= 25 then 'large' when quantity >= 10 then 'medium' else 'small' end as size,
               price / nullif(quantity - 10, 0) as guarded, least(price, pbm_fee, null) as lower_of,
               greatest(price, pbm_fee) as higher_of, abs(pbm_fee - price) as gap, {ratio('price / 7', 2)} as rounded,
               (quantity > 5 and quantity not in (7, 8)) or price is null as tested
        from claims""",
)
add(
    "d1_d2_d3_d5_d6_calendar",
    lambda b: b.landing["lookups"].select(
        "lookup_id", *[part.alias(name) for name, part in dates.calendar_parts(F.to_date("looked_up_at")).items()]
    ),
    """select lookup_id, year(looked_up_at)::int as year, quarter(looked_up_at)::int as quarter,
              month(looked_up_at)::int as month, monthname(looked_up_at) as month_name,
              date_trunc('month', looked_up_at)::date as month_start, date_trunc('week', looked_up_at)::date as week_start,
              dayofweek(looked_up_at)::int as day_of_week, dayname(looked_up_at) as day_name,
              dayofweek(looked_up_at) in (0, 6) as is_weekend
       from lookups""",
)


def differences(b: Bench) -> DataFrame:
    # The events carry odd seconds; each is compared with a time of its own some way off.
    start = F.col("ts")
    seconds = (F.col("event_id") * 37 % 20000 - 10000).cast("decimal(18,6)")
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return b.table("events").select(
        "event_id",
        dates.hours_between(start, end).alias("hours"),
        dates.minutes_between(start, end).alias("minutes"),
    )


add(
    "d4_boundaries_crossed",
    differences,
    """select event_id, date_diff('hour', ts, ts + to_seconds(event_id * 37 % 20000 - 10000)) as hours,
              date_diff('minute', ts, ts + to_seconds(event_id * 37 % 20000 - 10000)) as minutes
       from events""",
)
add(
    "d7_us_dates",
    lambda b: b.table("orders").select(
        "o_orderkey",
        parsing.parse_us_date(
            F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit(" "), F.date_format("o_orderdate", "M/d/yyyy")))
            .when(F.col("o_orderkey") % 5 == 2, F.date_format("o_orderdate", "M/d/yy"))
            .when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("2/30/"), F.year("o_orderdate").cast("string")))
            .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
        ).alias("day"),
    ),
    """select o_orderkey, case when o_orderkey % 5 in (1, 4) then cast(o_orderdate as date) end as day from orders""",
)
add(
    "d8_iso_timestamps",
    lambda b: v2(b).filter("reason IS NULL").select("event_id", "event_time"),
    f"select event_id, event_time from ({V2_SQL}) where event_time is not null",
)
add(
    "js1_json_records",
    lambda b: adapters.raw_reverts(b.spark, b.sf_dir).select(field_struct("reverts").alias("r")).select(
        "r.id", "r.claim_id", F.col("r.timestamp").alias("event_time"),
        F.get_json_object(F.to_json("r"), "$.id").alias("round_trip"),
    ),
    """select json_extract_string(raw_payload, '$.id') as id, json_extract_string(raw_payload, '$.claim_id') as claim_id,
              json_extract_string(raw_payload, '$.timestamp') as event_time, json_extract_string(raw_payload, '$.id') as round_trip
       from raw_reverts""",
)
add(
    "u1_partner_fee_share",
    lambda b: b.fee_fact.select("claim_id", "fee_type", "pbm_fee", "partner_fee"),
    "select claim_id, fee_type, pbm_fee, partner_fee::double as partner_fee from priced",
)


def policy_grid(b: Bench) -> DataFrame:
    grid = {}
    for duplicates in ("quarantine_all", "keep_earliest"):
        for basis in ("as_of_fill", "latest"):
            costs = b.under(duplicate_claims=duplicates, cost_basis=basis).slv_claim_costs
            uncosted = money.count_true(F.col("flag_cost_unavailable"))
            grid[f"{duplicates}/{basis}"] = costs.agg(rows(), uncosted.alias("uncosted"))
    return stacked(**grid)


POLICY_SQL = "\nunion all ".join(
    f"""select count(*) as n_rows, count(*) filter (not exists (
            select 1 from slv_nadac n where n.ndc = c.ndc {'and n.as_of_date <= c.filled_date' if basis == 'as_of_fill' else ''}
        )) as uncosted, '{policy}/{basis}' as part from {claims} c"""
    for policy, claims in (("quarantine_all", "slv_claims"), ("keep_earliest", "slv_claims_earliest"))
    for basis in ("as_of_fill", "latest")
)
add("u2_policies", policy_grid, POLICY_SQL)

# --- Q: reports ---------------------------------------------------------------------------------

PERCENT = "100.0 * sum(({0})::int) / nullif({1}, 0)"
Q1_SQL = f"""
    select partner, count(*) as claims, sum(net_fills)::bigint as fills, {total('sum(net_revenue)')} as revenue,
           {total('sum(net_pbm_fee)')} as pbm_fee_collected, {total('sum(net_partner_fee)')} as paid_to_partner,
           {total('sum(net_retained_margin)')} as margin_retained,
           {ratio('100.0 * sum(net_partner_fee) / nullif(sum(net_pbm_fee), 0)', 1)} as pct_of_fee_paid_out,
           {ratio(PERCENT.format('is_reverted', 'count(*)'), 2)} as revert_rate_pct
    from fct_claim where chain = '{CHAIN}' group by partner"""
add("q1_partner_value", lambda b: reports.partner_value(b.fee_fact, CHAIN), Q1_SQL)
add(
    "q2_conversion_funnel",
    lambda b: reports.conversion_funnel(b.fct_lookup),
    f"""select partner, channel, count(*) as lookups, count(*) filter (converted_to_valid_claim) as claims,
               {ratio(PERCENT.format('converted_to_valid_claim', 'count(*)'), 2)} as conversion_pct,
               count(*) filter (is_reverted) as reverted,
               {ratio('100.0 * count(*) filter (is_reverted) / nullif(count(*) filter (converted_to_valid_claim), 0)', 2)} as revert_rate_pct,
               {total('coalesce(sum(net_retained_margin), 0)')} as margin
        from fct_lookup group by partner, channel""",
)
add(
    "q3_data_quality",
    lambda b: reports.data_quality(b.brz_rejects, b.brz_claims, b.slv_pharmacies),
    """select 'rejected at ingest' as stage, stream, reject_reason as reason, count(*) as records
       from brz_rejects group by all
       union all select 'excluded in silver', 'claims', 'duplicate_claim_id',
                        count(*) filter (flag_duplicate_claim_id) from brz_claims
       union all select 'excluded in silver', 'claims', 'pharmacy_not_in_reference',
                        count(*) filter (npi not in (select npi from slv_pharmacies)) from unique_claims""",
)
add(
    "q4_margin_by_drug",
    lambda b: reports.margin_by_drug(b.fct_claim, b.dim_drug),
    f"""select ndc, any_value(d.ndc_description) as ndc_description, any_value(d.is_generic) as is_generic, count(*) as claims,
               {total('sum(net_revenue)')} as revenue, {total('sum(net_drug_cost)')} as est_drug_cost,
               {total('sum(net_retained_margin)')} as retained_margin,
               {ratio('avg(unit_price - nadac_per_unit)', 4)} as avg_unit_spread,
               count(*) filter (flag_cost_unavailable) as claims_without_cost
        from fct_claim f join dim_drug d using (ndc) group by ndc order by retained_margin desc, ndc limit 25""",
)
add(
    "q5_fee_term_scenario",
    lambda b: reports.fee_term_scenario(b.fee_fact, b.dim_partner, 1.0),
    f"""select partner, d.fee_type, coalesce(fee_cents, fee_percentage) as term, sum(net_fills)::bigint as fills,
               {total('sum(net_pbm_fee)')} as fee_collected, {total('sum(net_partner_fee)')} as paid_now,
               {total('sum(net_retained_margin)')} as retained_now, {total('sum(net_fills)')} as paid_if_flat,
               {total('sum(net_pbm_fee) - sum(net_fills)')} as retained_if_flat,
               {total('sum(net_partner_fee) - sum(net_fills)')} as gain
        from fct_claim f join dim_partner d using (partner) group by 1, 2, 3""",
)
add(
    "q6_exclusion_cost",
    lambda b: reports.exclusion_cost(b.brz_claims),
    f"select count(*) as claims, {total('sum(price)')} as gross_price from brz_claims where flag_duplicate_claim_id",
)
add(
    "q7_retained_by_partner",
    lambda b: reports.retained_by_partner(b.fee_fact),
    f"select partner, {total('sum(net_retained_margin)')} as retained_margin from fct_claim group by 1",
)

# --- M: metrics ---------------------------------------------------------------------------------

CLAIM_METRIC_SQL = {
    "retained_margin": "sum(net_retained_margin)",
    "retained_margin_per_fill": "sum(net_retained_margin) / sum(net_fills)",
    "fee_payout_ratio": "sum(net_partner_fee) / sum(net_pbm_fee)",
    "fee_collected": "sum(net_pbm_fee)",
    "fills": "sum(net_fills)",
    "reversal_rate": "count(*) filter (is_reverted) / count(*)",
    "margin_lost_to_reversal": "sum(retained_margin) filter (is_reverted)",
    "cost_coverage": "1 - count(*) filter (flag_cost_unavailable) / count(*)",
}
LOOKUP_METRIC_SQL = {
    "margin_per_lookup": "sum(net_retained_margin) / count(*)",
    "conversion_rate": "count(*) filter (converted_to_valid_claim) / count(*)",
}


def metric(number: int, name: str, source: str, definitions: Callable[[], dict[str, Column]], sql: str) -> None:
    """A metric over its whole table and, for the facts, also per partner."""

    def run(b: Bench) -> DataFrame:
        only = {name: money.round_total(definitions()[name], 4)}
        by = "partner" if source.startswith("fct_") else "source_file"
        # Only cost coverage looks at costs.
        table = b.fee_fact if source == "fct_claim" and name != "cost_coverage" else getattr(b, source)
        return metrics.measure_overall_and_by(table, only, by)

    by = "partner" if source.startswith("fct_") else "source_file"
    add(
        f"m{number}_{name}",
        run,
        f"""select {total(sql, 4)} as {name}, 'all' as of from {source}
            union all select {total(sql, 4)}, {by} from {source} group by {by}""",
    )


metric(1, "retained_margin", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["retained_margin"])
metric(2, "retained_margin_per_fill", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["retained_margin_per_fill"])
metric(3, "margin_per_lookup", "fct_lookup", metrics.lookup_metrics, LOOKUP_METRIC_SQL["margin_per_lookup"])
metric(4, "fee_payout_ratio", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["fee_payout_ratio"])
metric(5, "fee_collected", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["fee_collected"])
metric(6, "fills", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["fills"])
metric(7, "conversion_rate", "fct_lookup", metrics.lookup_metrics, LOOKUP_METRIC_SQL["conversion_rate"])
metric(8, "reversal_rate", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["reversal_rate"])
metric(
    9,
    "margin_lost_to_reversal",
    "fct_claim",
    metrics.claim_metrics,
    "coalesce(sum(retained_margin) filter (is_reverted), 0)",
)
REJECTION_SQL = """
    (select count(*) from brz_rejects) / (
        (select count(*) from judged_claims) + (select count(*) from judged_reverts) + (select count(*) from judged_lookups))"""
add(
    "m10_rejection_rate",
    lambda b: metrics.rejection_rate(b.brz_rejects, b.clean("claims"), b.clean("reverts"), b.clean("lookups")).select(
        F.round("rejection_rate", 6).alias("rejection_rate")
    ),
    f"select {ratio(REJECTION_SQL, 6)} as rejection_rate",
)
metric(11, "cost_coverage", "fct_claim", metrics.claim_metrics, CLAIM_METRIC_SQL["cost_coverage"])
metric(
    12,
    "excluded_claim_value",
    "brz_claims",
    metrics.bronze_metrics,
    "coalesce(sum(price) filter (flag_duplicate_claim_id), 0)",
)
ALL_METRICS_SQL = "\nunion all ".join(
    [f"select '{m}' as metric, {total(e, 4)} as value from fct_claim" for m, e in CLAIM_METRIC_SQL.items()]
    + [f"select '{m}', {total(e, 4)} from fct_lookup" for m, e in LOOKUP_METRIC_SQL.items()]
    + [f"select 'excluded_claim_value', {total('sum(price)', 4)} from brz_claims where flag_duplicate_claim_id"]
    + [f"select 'rejection_rate', {total(REJECTION_SQL, 4)}"]
)
add(
    "m_all_metrics",
    lambda b: metrics.all_metrics(
        b.fct_claim, b.fct_lookup, b.brz_claims, b.brz_rejects, b.clean("claims"), b.clean("reverts"), b.clean("lookups")
    ).withColumn("value", money.round_total(F.col("value"), 4)),
    ALL_METRICS_SQL,
)

# --- T: data tests, most of them over tables that break the rule ----------------------------------

add("t1_unique", lambda b: checks.unique(b.brz_claims, "claim_id"),
    "select claim_id, count(*) as n_records from claims group by 1 having count(*) > 1")
add("t2_not_null", lambda b: checks.not_null(b.fee_fact, "partner").select("claim_id", "partner"),
    "select claim_id, partner from fct_claim where partner is null")
add("t3_relationships", lambda b: checks.relationships(b.slv_lookups, "ndc", b.slv_nadac, "ndc").select("lookup_id", "ndc"),
    "select lookup_id, ndc from slv_lookups where ndc not in (select ndc from slv_nadac)")
add("t4_accepted_values", lambda b: checks.accepted_values(b.slv_lookups, "channel", ["1-urgent", "2-high", "3-medium"]),
    "select channel, count(*) as n_records from slv_lookups where channel not in ('1-urgent', '2-high', '3-medium') group by 1")
add("t5_unique_combination", lambda b: checks.unique_combination(b.landing["claims"], ["ndc", "npi"]),
    "select ndc, npi, count(*) as n_records from claims group by 1, 2 having count(*) > 1")
add(
    "t6_bronze_drops_nothing",
    lambda b: assertions.bronze_drops_nothing(
        {
            "claims": (b.brz_claims, b.landing["claims"]),
            "lookups": (b.brz_lookups, b.landing["lookups"]),
            "claims in scope": (b.slv_claims, b.landing["claims"]),
        }
    ),
    """select 'claims in scope' as stream, (select count(*) from slv_claims) as bronze_rows,
              (select count(*) from claims) as landing_rows""",
)


def both_reconciliations(b: Bench) -> DataFrame:
    each = {}
    for policy in ("quarantine_all", "keep_earliest"):
        w = b.under(duplicate_claims=policy)
        counts = assertions.reconciliation(w.brz_claims, w.resolved_claims, w.slv_claims, w.slv_pharmacies)
        broken = assertions.bronze_reconciles_to_silver(w.brz_claims, w.resolved_claims, w.slv_claims, w.slv_pharmacies)
        each[policy] = counts
        each[f"{policy}: broken"] = broken
    return stacked(**each)


add(
    "t7_bronze_reconciles",
    both_reconciliations,
    "\nunion all ".join(
        f"""select (select count(*) from claims) as bronze_rows, (select count(*) from {kept}) as silver_rows,
                   (select count(*) from claims) - (select count(*) from {resolved}) as duplicate_rows,
                   (select count(*) from {resolved} where npi not in (select npi from slv_pharmacies)) as out_of_scope_rows,
                   '{policy}' as part"""
        for policy, resolved, kept in (
            ("quarantine_all", "unique_claims", "slv_claims"),
            ("keep_earliest", "earliest_claims", "slv_claims_earliest"),
        )
    ),
)
add(
    "t8_cost_coverage",
    lambda b: assertions.claims_have_costs(b.fct_claim).withColumn("uncosted_pct", F.round("uncosted_pct", 6)),
    f"""select count(*) as claims, count(*) filter (flag_cost_unavailable) as uncosted,
               {ratio('100.0 * count(*) filter (flag_cost_unavailable) / count(*)', 6)} as uncosted_pct from fct_claim
        having uncosted_pct > 10""",
)


def overpaid(b: Bench) -> DataFrame:
    """The claim fact with some partner fees raised far above the fee."""
    return b.fee_fact.withColumn(
        "partner_fee", F.when(F.col("quantity") == 50, F.col("pbm_fee") + 5).otherwise(F.col("partner_fee"))
    )


add("t9_fee_identity", lambda b: assertions.fee_identity(overpaid(b)),
    "select claim_id from fct_claim where quantity = 50 and abs(pbm_fee + 5 + retained_margin - pbm_fee) > 0.0001")
add("t9_fee_identity_holds", lambda b: assertions.fee_identity(b.fee_fact),
    "select claim_id from fct_claim where abs(partner_fee + retained_margin - pbm_fee) > 0.0001")
add("t10_snapshots_loaded", lambda b: assertions.snapshots_loaded(b.brz_nadac, 100),
    """select count(*) as rows_loaded, count(distinct as_of_date) as snapshots from brz_nadac
       having count(distinct as_of_date) < 100""")
add("t11_partner_fee_within_fee", lambda b: assertions.partner_fee_within_fee(overpaid(b)),
    "select claim_id, pbm_fee, pbm_fee + 5 as partner_fee from fct_claim where quantity = 50")
add("t12_partner_terms_exclusive", lambda b: assertions.partner_terms_exclusive(b.brz_partners),
    "select partner from partners where (fee_cents is null) = (fee_percentage is null)")
add(
    "t13_reverted_count_nothing",
    lambda b: assertions.reverted_count_nothing(b.fct_claim.withColumn(
        "net_revenue", F.when(F.col("quantity") == 50, F.col("price")).otherwise(F.col("net_revenue")))),
    "select claim_id from fct_claim where is_reverted and quantity = 50 and price <> 0",
)
add(
    "t14_reverts_follow_fills",
    lambda b: assertions.reverts_follow_fills(
        b.fee_fact.withColumn("filled_at", F.col("filled_at") + F.expr("INTERVAL '1' DAY"))),
    """select claim_id, filled_at + interval 1 day as filled_at, reverted_at from fct_claim
       where reverted_at < filled_at + interval 1 day""",
)
add("t14_claims_unique", lambda b: assertions.claims_unique(b.fee_fact.unionByName(b.fee_fact.filter("is_reverted"))),
    "select claim_id, 2::bigint as n_records from fct_claim where is_reverted")
add(
    "t15_acceptance",
    lambda b: assertions.acceptance(b.fct_claim, b.fct_lookup, b.slv_claims, b.slv_claim_costs, b.slv_lookups),
    """select 'cost is known on the fill date' as rule, count(*) as misses from fct_claim where cost_as_of_date > date_day
       union all select 'cost join keeps the claim count',
                        abs((select count(*) from slv_claim_costs) - (select count(*) from slv_claims))
       union all select 'lookup fact keeps the lookup count',
                        abs((select count(*) from fct_lookup) - (select count(*) from slv_lookups))""",
)
add("t16_flat_term", lambda b: assertions.flat_term_in_dollars(overpaid(b), b.dim_partner),
    """select claim_id, partner, pbm_fee + 5 as partner_fee from fct_claim join dim_partner using (partner)
       where dim_partner.fee_type = 'flat' and quantity = 50 and pbm_fee >= fee_cents / 100
             and round(pbm_fee + 5, 4) <> round(fee_cents / 100, 4)""")
add(
    "t16_percentage_term",
    lambda b: assertions.percentage_term_share(overpaid(b), b.dim_partner).withColumn("paid", F.round("paid", 6)),
    f"""select partner, {ratio('sum(case when quantity = 50 then pbm_fee + 5 else partner_fee end) / sum(pbm_fee)', 6)} as paid,
               any_value(fee_percentage) / 100 as stated
        from fct_claim f join dim_partner d using (partner) where d.fee_type = 'percentage' group by partner
        having abs(paid - stated) > 0.001""",
)
add(
    "t16_zero_term",
    lambda b: assertions.zero_term_partners(overpaid(b), b.dim_partner).withColumn("paid", money.round_total(F.col("paid"))),
    f"""select partner, count(*) as claims, {total('sum(case when quantity = 50 then pbm_fee + 5 else partner_fee end)')} as paid
        from fct_claim join dim_partner using (partner) where fee_cents = 0 group by partner""",
)



def all_tests(b: Bench) -> DataFrame:
    """All declared tests over stored tables."""
    for name in ("slv_claims", "slv_reverts", "slv_nadac", "fct_claim", "fct_lookup"):
        b.replace(name, stage(getattr(b, name), name))
    return suite.run_tests(b)


def violations(test: str, sql: str) -> str:
    return f"select '{test}' as test, (select count(*) from ({sql})) as violations"


def all_tests_sql() -> str:
    parts = [violations(f"{t}.{c}: not_null", f"select 1 from {t} where {c} is null") for t, cs in suite.NOT_NULL.items() for c in cs]
    parts += [violations(f"{t}.{c}: unique", f"select {c} from {t} where {c} is not null group by 1 having count(*) > 1") for t, c in suite.UNIQUE.items()]
    parts += [violations(f"{t}.{c}: relationships", f"select 1 from {t} where {c} is not null and {c} not in (select {c} from {p})") for t, c, p in suite.RELATIONSHIPS]
    parts += [
        violations("dim_partner.fee_type: accepted_values", "select 1 from dim_partner where fee_type not in ('flat', 'percentage')"),
        violations("slv_nadac.ndc, as_of_date: unique", "select 1 from slv_nadac group by ndc, as_of_date having count(*) > 1"),
        violations("bronze drops nothing", "select 1 where (select count(*) from brz_claims) <> (select count(*) from claims)"),
        violations(
            "bronze reconciles to silver",
            """select 1 where (select count(*) from brz_claims) <> (select count(*) from slv_claims)
               + (select count(*) from brz_claims) - (select count(*) from unique_claims)
               + (select count(*) from unique_claims where npi not in (select npi from slv_pharmacies))""",
        ),
        violations("claims have costs", "select 1 from fct_claim having 100.0 * count(*) filter (flag_cost_unavailable) / count(*) > 10"),
        violations("fee identity", "select 1 from fct_claim where abs(partner_fee + retained_margin - pbm_fee) > 0.0001"),
        violations("snapshots loaded", "select 1 from brz_nadac having count(*) = 0 or count(distinct as_of_date) < 10"),
        violations("partner fee within fee", "select 1 from fct_claim where partner_fee > pbm_fee + 0.0001"),
        violations("partner terms exclusive", "select 1 from dim_partner where (fee_cents is null) = (fee_percentage is null)"),
        violations(
            "reverted claims count nothing",
            """select 1 from fct_claim where is_reverted and (net_fills <> 0 or net_revenue <> 0 or net_quantity <> 0
               or net_pbm_fee <> 0 or net_partner_fee <> 0 or net_retained_margin <> 0 or net_pharmacy_margin <> 0 or net_drug_cost <> 0)""",
        ),
    ]
    return "select test, violations, violations = 0 as passed from (" + " union all ".join(parts) + ")"


add("t_all_tests", all_tests, all_tests_sql())

# --- P: marts, history, incremental build, ledger, shifts -----------------------------------------

add(
    "p1_partner_performance",
    lambda b: rounded(
        marts.gld_partner_performance(b.fee_fact),
        ["revenue", "fee_collected", "fee_paid_out", "margin_retained"],
        ["payout_ratio", "revert_rate"],
    ),
    f"""select partner, chain, date_trunc('month', date_day)::date as month_start, count(*) as claims,
               sum(net_fills)::bigint as fills, {total('sum(net_revenue)')} as revenue,
               {total('sum(net_pbm_fee)')} as fee_collected, {total('sum(net_partner_fee)')} as fee_paid_out,
               {total('sum(net_retained_margin)')} as margin_retained,
               {ratio('sum(net_partner_fee) / nullif(sum(net_pbm_fee), 0)', 6)} as payout_ratio,
               {ratio('count(*) filter (is_reverted) / count(*)', 6)} as revert_rate
        from fct_claim group by 1, 2, 3""",
)
add(
    "p2_conversion_funnel_mart",
    lambda b: rounded(
        marts.gld_conversion_funnel(b.fct_lookup), [], ["conversion_rate", "revert_rate", "margin_per_lookup"]
    ),
    f"""select partner, channel, date_trunc('month', date_day)::date as month_start, count(*) as lookups,
               count(*) filter (converted_to_valid_claim) as claims,
               {ratio('count(*) filter (converted_to_valid_claim) / count(*)', 6)} as conversion_rate,
               {ratio('count(*) filter (is_reverted) / nullif(count(*) filter (converted_to_valid_claim), 0)', 6)} as revert_rate,
               {ratio('coalesce(sum(net_retained_margin), 0) / count(*)', 6)} as margin_per_lookup
        from fct_lookup group by 1, 2, 3""",
)


def rounded(df: DataFrame, totals: list[str], ratios: list[str]) -> DataFrame:
    for name in totals:
        df = df.withColumn(name, money.round_total(F.col(name)))
    for name in ratios:
        df = df.withColumn(name, money.round_ratio(F.col(name), 6))
    return df


def history(b: Bench) -> DataFrame:
    versions = adapters.partner_versions(b.spark, b.sf_dir)
    return scd2.build_history(versions, "partner", "version_date", ["fee_cents", "fee_percentage"])


HISTORY_SQL = """
    select partner, fee_cents, fee_percentage, date '1995-01-01' as valid_from,
           case when partner in ('AUTOMOBILE', 'HOUSEHOLD') then date '1998-07-01' end as valid_to,
           partner not in ('AUTOMOBILE', 'HOUSEHOLD') as is_current from partners
    union all
    select partner, null, case when partner = 'AUTOMOBILE' then 40.0 else 60.0 end, date '1998-07-01', null, true
    from partners where partner in ('AUTOMOBILE', 'HOUSEHOLD')"""
add("p3_partner_history", history, HISTORY_SQL)
add(
    "p3_dated_partner_terms",
    lambda b: warehouse.Warehouse(
        dict(b.landing) | {"partner_history": history(b)}, warehouse.Policies(partner_terms=warehouse.DATED_TERMS)
    ).fee_fact.select("claim_id", "partner", "fee_type", "partner_fee"),
    f"""with h as ({HISTORY_SQL}),
             claim_terms as (select c.claim_id, c.pbm_fee, l.partner, h.fee_cents, h.fee_percentage
                             from slv_claims c left join converting l using (claim_id)
                             left join h on h.partner = l.partner and c.filled_date >= h.valid_from
                                        and c.filled_date < coalesce(h.valid_to, date '9999-01-01'))
        select claim_id, partner,
               case when fee_cents is not null then 'flat' when fee_percentage is not null then 'percentage' end as fee_type,
               case when fee_cents is not null then least(fee_cents / 100, pbm_fee)
                    when fee_percentage is not null then pbm_fee * (fee_percentage / 100) else 0 end as partner_fee
        from claim_terms""",
)
CUTOFF = "2000-01-01"


def p4(b: Bench, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Build the facts from what came before the cutoff, then bring them up to date with the rest."""
    known, fresh = dict(b.landing), dict(b.landing)
    for stream, time in (("claims", "filled_at"), ("reverts", "reverted_at"), ("lookups", "looked_up_at")):
        before = F.col(time) < F.lit(CUTOFF).cast("timestamp_ntz")
        known[stream], fresh[stream] = b.landing[stream].filter(before), b.landing[stream].filter(~before)
    database = f"refresh_{uuid.uuid4().hex}"
    b.spark.sql(f"CREATE DATABASE {database} LOCATION '{b.scratch('database')}'")
    claims, lookups = f"{database}.fct_claim", f"{database}.fct_lookup"
    before = warehouse.Warehouse(known)
    incremental.store_fct_claim(before.fct_claim, claims, "month", buckets)
    incremental.store_fct_claim(before.fct_lookup, lookups, "month", buckets)
    incremental.refresh_fct_claim(b.spark, claims, known, fresh, "month", lookup_table=lookups)
    return b.spark.table(claims).select(*b.fct_claim.columns), b.spark.table(lookups).select(*b.fct_lookup.columns)


add("p4_incremental_fct_claim", lambda b: p4(b)[0], "select * from fct_claim")
add("p4_incremental_fct_lookup", lambda b: p4(b)[1], "select * from fct_lookup")
add("p4_incremental_by_bucket", lambda b: p4(b, 8)[1], "select * from fct_lookup")
add(
    "p4_lookback_suffices",
    lambda b: incremental.lookback_suffices(b.fct_claim, 72),
    "select max(hours_to_revert) as longest_hours from fct_claim having max(hours_to_revert) > 72 * 0.8",
)
# A stage without rows is worth nothing, so that the stages add up to what landed.
EMPTY_IS_ZERO = "coalesce(sum(price), 0)"
add(
    "p5_revenue_reconciliation",
    lambda b: marts.gld_revenue_reconciliation(
        b.brz_claims, b.landing["claims_rejects"], b.resolved_claims, b.slv_pharmacies, b.fct_claim
    ).withColumn("gross_price", money.round_total(F.col("gross_price"))),
    f"""select 'landed' as stage, count(*) as claims, {total(EMPTY_IS_ZERO)} as gross_price from claims
        union all select 'rejected at ingest', count(*), null from judged_claims where reject_reason is not null
        union all select 'excluded: duplicate claim id', count(*), {total(EMPTY_IS_ZERO)} from brz_claims where flag_duplicate_claim_id
        union all select 'excluded: pharmacy not in reference', count(*), {total(EMPTY_IS_ZERO)} from unique_claims
                  where npi not in (select npi from slv_pharmacies)
        union all select 'reverted', count(*), {total(EMPTY_IS_ZERO)} from fct_claim where is_reverted
        union all select 'net revenue', count(*), {total('coalesce(sum(net_revenue), 0)')} from fct_claim where not is_reverted""",
)
add(
    "p6_stale_streams",
    lambda b: assertions.stale_streams(
        {
            "claims": (b.landing["claims"], "filled_at"),
            "reverts": (b.landing["reverts"], "reverted_at"),
            "lookups": (b.landing["lookups"], "looked_up_at"),
        },
        "2001-11-06T00:00:00",
        72,
    ),
    """select * from (select 'claims' as stream, max(filled_at) as newest from claims
                      union all select 'reverts', max(reverted_at) from reverts
                      union all select 'lookups', max(looked_up_at) from lookups)
       where newest < timestamp '2001-11-06' - interval 72 hour""",
)
LOAD_OF_DAY = "date_format(ts, 'yyyy-MM-dd')"


def p6(b: Bench) -> DataFrame:
    judged = {s: b.judged(s, LOAD_OF_DAY) for s in ("claims", "reverts", "lookups")}
    refused = stacked(**{s: t.filter("reject_reason IS NOT NULL").select("load_id") for s, t in judged.items()})
    clean = {s: t.filter("reject_reason IS NULL") for s, t in judged.items()}
    shifts = assertions.rejection_shifts(refused.withColumnRenamed("part", "stream"), clean, 4, 0.05)
    return rounded(shifts, ["usual_records"], ["rate", "usual_rate"])


add(
    "p6_rejection_shifts",
    p6,
    f"""with judged as (
            select 'claims' as stream, substr(claim_id, 2) as event_id, reject_reason from judged_claims
            union all select 'reverts', substr(revert_id, 2), reject_reason from judged_reverts
            union all select 'lookups', substr(lookup_id, 2), reject_reason from judged_lookups),
        loads as (
            select stream, strftime(ts, '%Y-%m-%d') as load_id, count(*) as records, count(reject_reason) as rejects,
                   count(reject_reason) / count(*) as rate
            from judged j join events e on e.event_id = cast(j.event_id as bigint) group by 1, 2),
        compared as (
            select *, avg(records) over before as usual_records, avg(rate) over before as usual_rate from loads
            window before as (partition by stream order by load_id rows between 4 preceding and 1 preceding))
        select stream, load_id, records, rejects, {ratio('rate', 6)} as rate, {total('usual_records')} as usual_records,
               {ratio('usual_rate', 6)} as usual_rate
        from compared
        where abs(records - usual_records) > usual_records * 0.05 or abs(rate - usual_rate) > usual_rate * 0.05""",
)

# --- ST: streams ----------------------------------------------------------------------------------


def st1(b: Bench) -> DataFrame:
    target = b.scratch("stream-claims")
    start_quarantine(b.spark, b.json_folder("claims"), "claims", target, b.scratch("checkpoint"), "*.txt").awaitTermination()
    stored = landing.read_quarantine(b.spark, target, "claims")
    return stacked(
        clean=stored["claims"].select("claim_id", F.lit(None).cast("string").alias("reject_reason"), "load_id"),
        refused=stored["claims_rejects"].select(
            F.get_json_object("raw_payload", "$.id").alias("claim_id"), "reject_reason", "load_id"
        ),
    )


add(
    "st1_streaming_quarantine",
    st1,
    """select claim_id, reject_reason, '0' as load_id, case when reject_reason is null then 'clean' else 'refused' end as part
       from judged_claims""",
)
FAR_FUTURE = "2100-01-01"


def streamed(b: Bench, join: Callable[..., DataFrame]) -> DataFrame:
    """Claims and reverts as two streams of files; one late row on each side moves the watermark past all others."""
    late = F.lit(FAR_FUTURE).cast("timestamp_ntz")
    sides = {
        "claims": b.slv_claims.select("claim_id", "price", "filled_at"),
        # As they land: repeated reverts, and reverts of claims that are not in silver.
        "reverts": b.brz_reverts.drop("load_id"),
    }
    # Each side is built once; what else needs it reads the folder of its stream.
    folders = {name: b.scratch(f"stream-{name}") for name in sides}
    stored = {}
    for name, side in sides.items():
        side.write.parquet(folders[name])
        stored[name] = b.spark.read.schema(side.schema).parquet(folders[name])
    slv_reverts = silver.slv_reverts(stored["reverts"], stored["claims"])
    ends = {
        "claims": stored["claims"].agg(F.max("price").alias("price")).withColumn("filled_at", late),
        "reverts": slv_reverts.agg(F.max("revert_id").alias("revert_id")).withColumn("reverted_at", late),
    }
    streams = {}
    for name, shape in (("claims", ["claim_id", "price", "filled_at"]), ("reverts", ["claim_id", "revert_id", "reverted_at"])):
        # Read out of the folder before it is written to: one row.
        end = stage(ends[name].withColumn("claim_id", F.lit("end")), f"end-{name}")
        empty = stored[name].limit(0)
        empty.unionByName(end, allowMissingColumns=True).write.mode("append").parquet(folders[name])
        streams[name] = b.spark.readStream.schema(stored[name].select(*shape).schema).parquet(folders[name])
    joined = join(streams["claims"], streams["reverts"], "48 HOURS", "1 hour")
    target = b.scratch("stream-joined")
    (
        joined.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", b.scratch("checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return b.spark.read.schema(joined.schema).parquet(target).filter("claim_id <> 'end'")


add(
    "st2_claims_with_reverts",
    # Which of several reverts comes first is up to their arrival; whether there is one is not.
    lambda b: streamed(b, claims_with_reverts).select("claim_id", "price", "filled_at", "is_reverted"),
    """select claim_id, price, filled_at, exists (
              select 1 from brz_reverts r where r.claim_id = c.claim_id and r.reverted_at >= c.filled_at
                     and r.reverted_at <= c.filled_at + interval 48 hour) as is_reverted
       from slv_claims c""",
)
add(
    "st2_earliest_revert",
    lambda b: streamed(b, claims_with_earliest_revert),
    """select c.claim_id, c.price, c.filled_at, r.revert_id, r.reverted_at, r.claim_id is not null as is_reverted
       from slv_claims c left join (
              select s.claim_id, b.revert_id, b.reverted_at,
                     row_number() over (partition by s.claim_id order by b.reverted_at, b.revert_id) as place
              from slv_claims s join brz_reverts b
                   on b.claim_id = s.claim_id and b.reverted_at >= s.filled_at
                      and b.reverted_at <= s.filled_at + interval 48 hour
            ) r on r.claim_id = c.claim_id and r.place = 1""",
)
