"""Daily usage panels derived from fact tables, and the catalogue of their series."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgeline.schema import DATE, KEYS, TARGET

USAGE_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("compute_type", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("compute_hours", T.DoubleType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_usage_csv(spark: SparkSession, path: str) -> DataFrame:
    """Usage rows from CSV with a declared schema (no inference pass)."""
    return spark.read.schema(USAGE_SCHEMA).option("header", True).csv(path)


def read_usage(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A panel written by ``write_usage``; with bounds (ISO dates, both included) only their months are read."""
    rows = spark.read.schema(f"date date, {KEYS[0]} string, {KEYS[1]} string, {TARGET} double, month date").parquet(path)
    for bound, keep in ((first, lambda c, d: c >= d), (last, lambda c, d: c <= d)):
        if bound:
            day = F.lit(bound).cast("date")
            rows = rows.filter(keep(F.col("month"), F.trunc(day, "MM")) & keep(F.col(DATE), day))
    return rows.drop("month")


def write_usage(usage: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"):
    """Write a panel; parquet is laid out by month so that date filters prune folders."""
    if fmt == "csv":
        usage.write.mode(mode).option("header", True).csv(path)
    else:
        (
            usage.withColumn("month", F.trunc(DATE, "MM"))
            .repartition("month")
            .write.mode(mode)
            .partitionBy("month")
            .parquet(path)
        )


def daily_usage(facts: DataFrame, date, compute_type, customer_segment, value) -> DataFrame:
    """Facts summed to one row per (date, type, segment).

    Partial sums run before the shuffle, so a key that holds most of the facts still sends one
    row per day and task. After this step a series is never longer than its calendar.
    """
    return facts.groupBy(
        F.to_date(date).alias(DATE),
        F.col(compute_type).alias(KEYS[0]),
        F.col(customer_segment).alias(KEYS[1]),
    ).agg(F.sum(value).cast("double").alias(TARGET))


def from_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return daily_usage(
        table(spark, folder, "lineitem"), "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity"
    )


def from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order value by priority and market segment.

    Orders are summed per customer and day first: a customer with a third of all orders then
    brings a few rows per day to the join instead of every order.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    per_customer = orders.groupBy(
        "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_date")
    ).agg(F.sum("o_totalprice").alias("o_value"))
    joined = per_customer.join(
        customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    return daily_usage(joined, "o_date", "o_orderpriority", "c_mktsegment", "o_value")


def daily_events(spark: SparkSession, folder: str) -> DataFrame:
    """Short panel: event value per day and event type."""
    return (
        table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias(DATE), F.col("event_type").alias(KEYS[0]))
        .agg(F.sum("value").alias(TARGET), F.count(F.lit(1)).alias("n"))
    )


def series_catalog(usage: DataFrame, keys=KEYS) -> DataFrame:
    """Every series with its span."""
    return usage.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
    )


def scaffold(series: DataFrame, start, days: int, keys=KEYS) -> DataFrame:
    """One row per series and horizon date. ``start`` is an ISO date or a Column."""
    first = F.lit(start).cast("date") if isinstance(start, str) else start
    return (
        series.select(*keys)
        .distinct()
        .withColumn(DATE, F.explode(F.sequence(first, F.date_add(first, days - 1))))
        .select(DATE, *keys)
    )
