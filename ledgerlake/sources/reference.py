"""Reference tables and the dated price series: folders of CSV files with a header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.parsing import parse_number, parse_us_date, strip
from ledgerlake.sources.files import SEEN, first_line, is_hidden, listed, visible

# Published column names of the price series and ours.
PRICE_COLUMNS = {
    "NDC": "ndc",
    "NDC Description": "ndc_description",
    "NADAC Per Unit": "nadac_per_unit",
    "Effective Date": "effective_date",
    "As of Date": "as_of_date",
    "Pricing Unit": "pricing_unit",
    "Classification for Rate Setting": "rate_setting_class",
    "OTC": "is_otc",
}


def read_csv_dir(spark: SparkSession, path: str, glob: str = "*.csv", multi_line: bool = True) -> DataFrame:
    """Every column as text, named by each file's own header: files may have their columns in any order.

    Files are grouped by their first line, which the driver reads, and a group is read at once. A column that a
    file lacks is NULL in its rows. Quoted text may hold line breaks. Without ``multi_line`` it must not, and one huge
    file can be split. Files whose names start with ``_`` or ``.`` are read like others.
    """

    def read(*paths: str) -> DataFrame:
        return (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("pathGlobFilter", glob if paths == (path,) else f"{{{SEEN},}}{glob}")
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(list(paths))
        )

    found = listed(spark, path, glob)
    hidden = [f for f in found if is_hidden(f)]
    groups: dict[str, list[str]] = {}
    for name, _, _ in [f for f in found if not is_hidden(f)] + visible(spark, hidden):
        header = first_line(spark, name)
        if header is not None:
            groups.setdefault(header.removeprefix("\ufeff").rstrip("\r"), []).append(name)
    if not hidden and len(groups) < 2:
        return read(path)
    same = [read(*paths) for paths in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same) if same else read(path)


def _text(df: DataFrame, name: str) -> Column:
    """The stripped column, empty where it or its value is absent."""
    column = F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
    return F.coalesce(strip(column), F.lit(""))


def pharmacies(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    rows = read_csv_dir(spark, path)
    return rows.filter("npi != ''").select(
        _text(rows, "npi").alias("npi"), _text(rows, "chain").alias("chain"), F.lit(load_id).alias("load_id")
    )


def partners(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """Partner terms; a blank or unreadable term is NULL, zero stays zero."""
    rows = read_csv_dir(spark, path)
    return rows.filter("partner != ''").select(
        _text(rows, "partner").alias("partner"),
        parse_number(_text(rows, "fee_cents")).alias("fee_cents"),
        parse_number(_text(rows, "fee_percentage")).alias("fee_percentage"),
        F.lit(load_id).alias("load_id"),
    )


def prices(spark: SparkSession, path: str, load_id: str, multi_line: bool = True) -> DataFrame:
    """The price series. Rows without a usable cost are dropped (see price_losses); an unreadable date is NULL.

    Without ``multi_line`` no text may hold a line break, and one huge file is split over tasks.
    """
    return typed_prices(spark, path, load_id, multi_line).filter("nadac_per_unit IS NOT NULL")


def price_losses(spark: SparkSession, path: str) -> DataFrame:
    """How many rows of the price series are read, lack a cost and so don't land, and lack a date and so stay out of bronze."""
    cost, day = F.col("nadac_per_unit").isNull(), F.col("as_of_date").isNull()
    return typed_prices(spark, path, "").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(cost).alias("without_cost"),
        F.count_if(~cost & day).alias("without_date"),
    )


def typed_prices(spark: SparkSession, path: str, load_id: str, multi_line: bool = True) -> DataFrame:
    rows = read_csv_dir(spark, path, multi_line=multi_line)
    text = {ours: _text(rows, theirs) for theirs, ours in PRICE_COLUMNS.items()}
    typed = text | {
        "nadac_per_unit": parse_number(text["nadac_per_unit"]),
        "effective_date": parse_us_date(text["effective_date"]),
        "as_of_date": parse_us_date(text["as_of_date"]),
        "is_otc": F.upper(text["is_otc"]) == "Y",
    }
    return rows.select(*[column.alias(name) for name, column in typed.items()], F.lit(load_id).alias("load_id"))
