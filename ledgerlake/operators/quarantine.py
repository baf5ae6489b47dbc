"""Record-level validation: every record gets either typed columns or the reason it was refused."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.parsing import parse_iso_timestamp, parse_number

# The reasons.
MISSING = "missing_required_field"
BAD_TIMESTAMP = "unparseable_timestamp"
NON_NUMERIC = "non_numeric"
UNREADABLE_FILE = "unreadable_file"


@dataclass(frozen=True)
class Contract:
    """What a record of one stream must look like.

    ``columns`` maps each output column to the record field it comes from. The rules are conditions
    on output columns that refuse a record, tried in order after the structural checks.
    """

    columns: Mapping[str, str]
    required: Sequence[str]
    timestamps: Sequence[str]
    numbers: Sequence[str] = ()
    rules: Sequence[tuple[str, str]] = field(default=())

    @property
    def fields(self) -> list[str]:
        return list(dict.fromkeys(self.columns.values()))

    @property
    def schema(self) -> str:
        """The record as it is parsed: all text."""
        return ", ".join(f"`{name}` string" for name in self.fields)

    @property
    def typed_schema(self) -> str:
        """The output columns with their types."""
        types = dict.fromkeys(self.timestamps, "timestamp_ntz") | dict.fromkeys(self.numbers, "double")
        return ", ".join(f"`{target}` {types.get(source, 'string')}" for target, source in self.columns.items())


# The three event contracts.
CLAIMS = Contract(
    columns={
        "claim_id": "id",
        "npi": "npi",
        "ndc": "ndc",
        "price": "price",
        "quantity": "quantity",
        "pbm_fee": "pbm_fee",
        "filled_at": "timestamp",
    },
    required=("id", "npi", "ndc", "price", "quantity", "pbm_fee", "timestamp"),
    timestamps=("timestamp",),
    numbers=("price", "quantity", "pbm_fee"),
    rules=(("price < 0", "negative_price"), ("quantity <= 0", "non_positive_quantity")),
)
REVERTS = Contract(
    columns={"revert_id": "id", "claim_id": "claim_id", "reverted_at": "timestamp"},
    required=("id", "claim_id", "timestamp"),
    timestamps=("timestamp",),
)
LOOKUPS = Contract(
    columns={
        "lookup_id": "id",
        "claim_id": "claim_id",
        "ndc": "ndc",
        "partner": "partner",
        "channel": "channel",
        "looked_up_at": "timestamp",
    },
    required=("id", "ndc", "partner", "channel", "timestamp"),
    timestamps=("timestamp",),
)
CONTRACTS = {"claims": CLAIMS, "reverts": REVERTS, "lookups": LOOKUPS}


def missing_fields(record: Column, required: Sequence[str]) -> Column:
    """Reason naming all absent or null required fields in alphabetical order, else NULL."""
    absent = F.concat_ws(",", *[F.when(record[name].isNull(), F.lit(name)) for name in sorted(required)])
    return F.when(absent != "", F.concat(F.lit(f"{MISSING}:"), absent))


def bad_timestamp(typed: Mapping[str, Column], names: Sequence[str]) -> Column:
    """Reason if any timestamp could not be read, else NULL."""
    return F.coalesce(*[F.when(typed[name].isNull(), F.lit(BAD_TIMESTAMP)) for name in names])


def non_numeric(typed: Mapping[str, Column], names: Sequence[str]) -> Column:
    """Reason naming the number fields that hold no number, in declared order, else NULL."""
    words = F.concat_ws(",", *[F.when(typed[name].isNull(), F.lit(name)) for name in names])
    return F.when(words != "", F.concat(F.lit(f"{NON_NUMERIC}:"), words))


def validate(records: DataFrame, contract: Contract, payload: str = "raw_payload") -> DataFrame:
    """Type every record and name the first check it fails in ``reject_reason`` (NULL when clean).

    ``payload`` holds one JSON object per row. All columns are kept, and a reason given before stands.
    The order of the checks is missing fields, timestamps, numbers, then the contract's rules.
    """
    record = F.col("_record")
    typed = {name: record[name] for name in contract.fields}
    typed |= {name: parse_iso_timestamp(record[name]) for name in contract.timestamps}
    typed |= {name: parse_number(record[name]) for name in contract.numbers}
    values = F.struct(
        *[typed[source].alias(target) for target, source in contract.columns.items()],
        missing_fields(record, contract.required).alias("_missing"),
    )
    # Exploding an array of one keeps later filters on the reason from being pushed below the parsing,
    # which would parse every record again for each column such a filter mentions.
    judged = (
        records.withColumn("_record", F.from_json(payload, contract.schema))
        .select(*records.columns, F.inline(F.array(values)))
        .withColumn("reject_reason", F.coalesce(*_checks(contract, "reject_reason" in records.columns)))
    )
    others = [name for name in records.columns if name != "reject_reason"]
    return judged.select(*contract.columns, *others, "reject_reason")


def _checks(contract: Contract, judged_before: bool) -> list[Column]:
    """The reasons in order of precedence, each NULL where its check passes."""
    typed = {source: F.col(target) for target, source in contract.columns.items()}
    found = [F.col("_missing"), bad_timestamp(typed, contract.timestamps)]
    if contract.numbers:
        found.append(non_numeric(typed, contract.numbers))
    found += [F.when(F.expr(condition), F.lit(reason)) for condition, reason in contract.rules]
    return [F.col("reject_reason"), *found] if judged_before else found


def clean_rows(validated: DataFrame, contract: Contract, lineage: Sequence[str] = ()) -> DataFrame:
    """The typed columns of the records that passed."""
    return validated.filter("reject_reason IS NULL").select(*contract.columns, *lineage)


def reject_rows(
    validated: DataFrame, lineage: Sequence[str] = (), payload: str = "raw_payload"
) -> DataFrame:
    """Payload and reason of the records that failed."""
    return validated.filter("reject_reason IS NOT NULL").select(payload, "reject_reason", *lineage)
