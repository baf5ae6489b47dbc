"""The benchmark tables in the shape of the landed event and reference tables.

Line items act as claims, returned ones as reverts, orders as lookups, suppliers as pharmacies, and
each part has one price per quarter. Text records for the validation steps come from the events.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.quarantine import CONTRACTS, reject_rows, validate
from ledgerlake.sources.events import LINEAGE

LOAD_ID = "load-1"
# Flat terms in cents and percentage terms by partner.
PARTNER_TERMS = {
    "AUTOMOBILE": {"fee_cents": 100.0},
    "BUILDING": {"fee_percentage": 50.0},
    "FURNITURE": {"fee_cents": 0.0},
    "HOUSEHOLD": {"fee_percentage": 80.0},
    "MACHINERY": {"fee_cents": 25.0, "fee_percentage": 10.0},
}
GENERIC_TYPES = ("STANDARD", "ECONOMY", "PROMO")
FIRST_SNAPSHOT = "1996-01-01"
VERSION_DATES = ("1995-01-01", "1996-07-01", "1998-07-01")
TERMS_CHANGED = "1998-07-01"
# The columns in use. Stating them spares a job per read that would look them up.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# A task's share of a table, in bytes of its files, where each row makes many others or a file.
SHARE = 64 << 10


def spread_rows(rows: DataFrame, key: str, sf_dir: str, name: str, share: int = SHARE) -> DataFrame:
    """Rows of a table that is read by few tasks, dealt by key over as many as its files have shares."""
    path = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    files = path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration())
    tasks = -(-files.getContentSummary(path).getLength() // share)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _line_id() -> Column:
    return F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber"))


def _hours(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), count.cast("int"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("claim_id"),
        _text("l_suppkey").alias("npi"),
        _text("l_partkey").alias("ndc"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_quantity") * F.col("l_tax") * 1000).alias("pbm_fee"),
        (F.col("l_shipdate") + _hours(F.col("l_linenumber"))).alias("filled_at"),
        F.col("l_returnflag").alias("source_file"),
        F.lit(LOAD_ID).alias("load_id"),
    )


def reverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'R'")
        .select(
            F.concat(F.lit("r"), _line_id(), F.lit("-"), _text("l_partkey")).alias("revert_id"),
            _line_id().alias("claim_id"),
            (F.col("l_shipdate") + _hours(F.col("l_linenumber") + F.col("l_suppkey") % 72)).alias("reverted_at"),
            F.col("l_linestatus").alias("source_file"),
            F.lit(LOAD_ID).alias("load_id"),
        )
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("o_orderkey") - F.col("o_orderkey") % 2
    named = F.concat(base.cast("string"), F.lit("-"), (1 + base % 7).cast("string"))
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    # Never broadcast: the size guessed from compressed files is far below that of the rows.
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").hint("merge")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            _text("o_orderkey").alias("lookup_id"),
            F.when(F.col("o_orderstatus") != "P", named).alias("claim_id"),
            (F.col("o_orderkey") % 2100).cast("string").alias("ndc"),
            F.col("c_mktsegment").alias("partner"),
            F.when(unspecified, " ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("channel"),
            F.col("o_orderdate").alias("looked_up_at"),
            F.col("o_orderstatus").alias("source_file"),
            F.lit(LOAD_ID).alias("load_id"),
        )
    )


def pharmacies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter("s_acctbal >= 0")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("s_suppkey").alias("npi"),
            F.concat(F.lit(" "), "r_name").alias("chain"),
            F.lit(LOAD_ID).alias("load_id"),
        )
    )


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market segments in use with their fixed terms."""
    segment = F.col("c_mktsegment")

    def term(kind: str) -> Column:
        stated = [F.when(segment == name, F.lit(terms[kind])) for name, terms in PARTNER_TERMS.items() if kind in terms]
        return F.coalesce(*stated).alias(kind)

    return (
        table(spark, sf_dir, "customer")
        .select(segment)
        .filter(segment.isin(*PARTNER_TERMS))
        .distinct()
        .select(segment.alias("partner"), term("fee_cents"), term("fee_percentage"), F.lit(LOAD_ID).alias("load_id"))
    )


def nadac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price row per part and quarter that has orders; the quarters are as many as the calendar has."""
    quarters = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") >= F.lit(FIRST_SNAPSHOT).cast("timestamp_ntz"))
        .agg(F.collect_set(F.trunc(F.to_date("o_orderdate"), "quarter")))
    )
    parts = table(spark, sf_dir, "part").filter("p_partkey % 17 <> 0")
    return (
        spread_rows(parts, "p_partkey", sf_dir, "part")
        .withColumn("as_of_date", F.explode(quarters.scalar()))
        .select(
            _text("p_partkey").alias("ndc"),
            F.col("p_name").alias("ndc_description"),
            (F.col("p_retailprice") * (F.year("as_of_date") - 1985) / 100).alias("nadac_per_unit"),
            F.col("as_of_date").alias("effective_date"),
            "as_of_date",
            F.lit("EA").alias("pricing_unit"),
            F.when(F.col("p_type").isin(*GENERIC_TYPES), "G").otherwise("B").alias("rate_setting_class"),
            (F.col("p_size") < 10).alias("is_otc"),
            F.lit(LOAD_ID).alias("load_id"),
        )
    )


def partner_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated full copies of the partner terms: one partner changes its percentage, one its kind of term."""
    changed = F.col("version_date") >= F.lit(TERMS_CHANGED).cast("date")
    raised = changed & (F.col("partner") == "AUTOMOBILE")
    lowered = changed & (F.col("partner") == "HOUSEHOLD")
    dates = F.array(*[F.lit(day).cast("date") for day in VERSION_DATES])
    return (
        partners(spark, sf_dir)
        .withColumn("version_date", F.explode(dates))
        .select(
            "partner",
            "version_date",
            F.when(~raised, F.col("fee_cents")).alias("fee_cents"),
            F.when(raised, 40.0).when(lowered, 60.0).otherwise(F.col("fee_percentage")).alias("fee_percentage"),
        )
    )


class Landing(Mapping):
    """All landed tables by name, each made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._make = {
            source.__name__: partial(source, spark, sf_dir)
            for source in (claims, reverts, lookups, pharmacies, partners, nadac)
        } | {f"{stream}_rejects": partial(rejects, spark, sf_dir, stream) for stream in RAW_STREAMS}
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)


# --- text records ---------------------------------------------------------------------------


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _json_object(*parts: Column) -> Column:
    """Join ``,"name":value`` parts, dropping the first comma; NULL parts are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _pair(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value)


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def _event_time() -> Column:
    return F.when(_every(43), "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))


def _time_pair() -> Column:
    return F.when(~_every(61), _pair("timestamp", _quoted(_event_time())))


def _records(spark: SparkSession, sf_dir: str, payload: Column, load: str | None) -> DataFrame:
    """Payloads with lineage; ``load`` is an expression for the load id."""
    return table(spark, sf_dir, "events").select(
        payload.alias("raw_payload"),
        F.col("event_type").alias("source_file"),
        (F.expr(load) if load else F.lit(LOAD_ID)).alias("load_id"),
    )


def raw_claims(spark: SparkSession, sf_dir: str, load: str | None = None) -> DataFrame:
    """Claim records as JSON text; each way to fail occurs, alone and together with others."""
    amount = F.col("value").cast("decimal(12,2)").cast("string")
    price = (
        F.when(_every(41), '"n/a"')
        .when(_every(37), _quoted(amount))
        .when(_every(53), F.concat(F.lit("-1"), amount))
        .otherwise(amount)
    )
    payload = _json_object(
        _pair("id", _quoted(F.concat(F.lit("e"), _text("event_id")))),
        _pair("npi", F.when(_every(47), "null").otherwise(_quoted(F.col("user_id")))),
        _pair("ndc", _quoted(F.col("event_id") % 2000)),
        _pair("price", price),
        _pair("quantity", (F.col("event_id") % 59).cast("string")),
        _pair("pbm_fee", F.lit("2.75")),
        _time_pair(),
    )
    return _records(spark, sf_dir, payload, load)


def raw_reverts(spark: SparkSession, sf_dir: str, load: str | None = None) -> DataFrame:
    payload = _json_object(
        _pair("id", _quoted(F.concat(F.lit("r"), _text("event_id")))),
        _pair("claim_id", F.when(_every(29), "null").otherwise(_quoted(F.concat(F.lit("e"), _text("event_id"))))),
        _time_pair(),
    )
    return _records(spark, sf_dir, payload, load)


def raw_lookups(spark: SparkSession, sf_dir: str, load: str | None = None) -> DataFrame:
    payload = _json_object(
        _pair("id", _quoted(F.concat(F.lit("l"), _text("event_id")))),
        F.when(~_every(3), _pair("claim_id", F.when(_every(5), _quoted(_text("event_id"))).otherwise("null"))),
        _pair("ndc", (F.col("event_id") % 2000).cast("string")),
        F.when(~_every(31), _pair("partner", _quoted(F.col("event_type")))),
        _pair("channel", F.when(_every(7), '""').otherwise('"website"')),
        _time_pair(),
    )
    return _records(spark, sf_dir, payload, load)


RAW_STREAMS = {"claims": raw_claims, "reverts": raw_reverts, "lookups": raw_lookups}


def judged(spark: SparkSession, sf_dir: str, stream: str, load: str | None = None) -> DataFrame:
    """The text records of a stream after validation."""
    return validate(RAW_STREAMS[stream](spark, sf_dir, load), CONTRACTS[stream])


def rejects(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    return reject_rows(judged(spark, sf_dir, stream), LINEAGE)


def write_json_files(records: DataFrame, path: str, per_file: int = 500) -> None:
    """Store JSON texts as files that each hold one array, with a stray scalar among the records.

    Each file takes a bounded run of one partition's rows; nothing is shuffled.
    """

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["raw_payload"]
            runs = [texts.iloc[start : start + per_file] for start in range(0, len(texts), per_file)]
            yield pd.DataFrame({"value": ["[\n42,\n" + ",\n".join(run) + "\n]\n" for run in runs]})

    documents = records.select("raw_payload").mapInPandas(arrays, "value string")
    documents.write.option("maxRecordsPerFile", 1).text(path)
