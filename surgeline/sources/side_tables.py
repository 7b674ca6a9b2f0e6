"""Small side tables from delimited files: holidays, event log, planned demand.

Every table has a declared schema; nothing is inferred. A file whose header lacks a column stops the
read with the columns' names. A row that does not fit (a date that is none, a number with letters) is kept apart with its text, never
turned into nulls silently.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeline.functions.exprs import split_list

# The published columns of the side tables.
SCHEMAS = {
    "holidays": "date date, holiday_name string",
    "event_log": (
        "event_date date, event_end_date date, event_type string, event_name string, description string, "
        "affected_compute_types string, affected_segments string, magnitude string"
    ),
    "pipeline": (
        "event_name string, expected_date date, compute_type string, customer_segment string, "
        "estimated_daily_hours double, probability double, notes string"
    ),
}
LISTS = {"event_log": ["affected_compute_types", "affected_segments", "magnitude"]}
REJECTED = "_rejected"


@dataclass
class SideTable:
    """Rows that fit the schema, with delimited lists as arrays, and the text of those that don't."""

    rows: DataFrame
    rejected: DataFrame


def read_side_table(spark: SparkSession, path: str, kind: str) -> SideTable:
    raw = (
        spark.read.schema(f"{SCHEMAS[kind]}, {REJECTED} string")
        .option("header", True)
        .option("enforceSchema", False)  # the header has to name the schema's columns
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )
    fits = raw.filter(F.col(REJECTED).isNull()).drop(REJECTED)
    # a list that is missing has no members
    lists = {c: F.coalesce(F.filter(split_list(c), lambda x: x != ""), F.array().cast("array<string>")) for c in LISTS.get(kind, [])}
    return SideTable(fits.withColumns(lists) if lists else fits, raw.filter(F.col(REJECTED).isNotNull()))


def write_side_table(df: DataFrame, path: str, kind: str) -> None:
    """The table's columns in their published order, with a header; arrays become delimited lists."""
    types = dict(df.dtypes)
    names = [c.split()[0] for c in SCHEMAS[kind].split(", ")]
    flat = [F.array_join(c, "; ").alias(c) if types[c].startswith("array") else F.col(c) for c in names]
    df.select(*flat).write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
