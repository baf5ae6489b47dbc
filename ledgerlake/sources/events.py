"""Event streams: folders of JSON files, each one object or an array of objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.quarantine import CONTRACTS, UNREADABLE_FILE, validate
from ledgerlake.sources.arrays import array_records
from ledgerlake.sources.files import SEEN, all_plain, is_hidden, listed, visible

# Fixed value: what becomes of a record's origin.
LINEAGE = ("source_file", "load_id")


def json_files(
    spark: SparkSession, path: str, glob: str = "*.json", stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """One row per file below ``path`` (not its subfolders): whole text and file name."""
    reader = (spark.readStream if stream else spark.read).format("text").option("wholetext", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.option("pathGlobFilter", glob).load(path)
    return files.select("value", F.col("_metadata.file_name").alias("source_file"))


def json_records(files: DataFrame) -> DataFrame:
    """One row per record as JSON text in ``raw_payload``.

    Elements of an array that are not objects are skipped, as is a file holding a bare scalar. A file
    that is not JSON gives one row with its whole text and the reason, so that it is counted. The text
    is checked by streaming functions, which take files of any size.
    """
    text = F.col("value")
    end = F.rtrim(text, F.lit(" \t\r\n"))
    # Between brackets it must make an array of one value: text behind the value would be passed over otherwise.
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    whole_array, whole_object = one & end.endswith("]"), one & end.endswith("}")
    # The first character decides which check runs, so a file is checked once.
    kind = (
        F.when(text.rlike(r"^\s*\["), F.when(whole_array, "array").otherwise("broken"))
        .when(text.rlike(r"^\s*\{"), F.when(whole_object, "object").otherwise("broken"))
        .when(F.try_parse_json(text).isNull(), "broken")
        .otherwise("scalar")
    )
    elements = F.when(F.col("_kind") == "array", F.from_json(text, "array<string>")).when(
        F.col("_kind") != "scalar", F.array(text)
    )
    return (
        files.withColumn("_kind", kind)
        .select(
            "source_file",
            F.when(F.col("_kind") == "broken", F.lit(UNREADABLE_FILE)).alias("reject_reason"),
            F.explode(elements).alias("raw_payload"),
        )
        .filter(F.col("reject_reason").isNotNull() | F.col("raw_payload").rlike(r"^\s*\{"))
    )


# Parameter: files with more bytes that hold an array are read by many tasks.
SPLIT_ABOVE = 256 << 20


def read_json_dir(spark: SparkSession, path: str, glob: str = "*.json", split_above: int = SPLIT_ABOVE) -> DataFrame:
    """All records of a folder with their file name; unreadable files carry a reject reason.

    Files whose names start with ``_`` or ``.`` are read like others. An array in a file of more than ``split_above``
    bytes is read by many tasks; such files are scanned when the frame is made, see sources.arrays.
    """
    if all_plain(spark, path, glob, split_above):
        return json_records(json_files(spark, path, glob))
    found = listed(spark, path, glob)
    hidden = [f for f in found if is_hidden(f)]
    if not hidden and not any(size > split_above for _, _, size in found):
        return json_records(json_files(spark, path, glob))
    copies = visible(spark, hidden)
    readable = [f for f in found if not is_hidden(f)] + copies
    whole, parts = [p for p, _, size in readable if size <= split_above], []
    if large := [p for p, _, size in readable if size > split_above]:
        records, others = array_records(spark, large)
        parts.append(records)
        whole += others
    if whole:
        files = spark.read.format("text").option("wholetext", True).load(whole)
        parts.append(json_records(files.select("value", F.col("_metadata.file_name").alias("source_file"))))
    name, copied = F.col("source_file"), [n for _, n, _ in copies]
    shown = F.when(name.isin(copied), F.expr(f"substring(source_file, {len(SEEN) + 1})")).otherwise(name) if copied else name
    return reduce(DataFrame.unionByName, parts).withColumn("source_file", shown)


def validated_stream(
    spark: SparkSession, path: str, stream: str, load_id: str, glob: str = "*.json"
) -> DataFrame:
    """Read and judge one event folder: typed columns, reject reason, payload and lineage."""
    records = read_json_dir(spark, path, glob).withColumn("load_id", F.lit(load_id))
    return validate(records, CONTRACTS[stream])
