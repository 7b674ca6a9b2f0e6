"""Run records, model parts and versions kept as plain tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, key string, value double"
TREND_SCHEMA = (
    "compute_type string, customer_segment string, log_intercept double, "
    "daily_growth_rate double, origin_date date"
)


def metrics_long(wide: DataFrame, run_id: str) -> DataFrame:
    """One row per (run, metric) from a frame with one row per run."""
    keys = [c for c in wide.columns if c != run_id]
    doubles = wide.select(F.col(run_id).alias("run_id"), *[F.col(k).cast("double").alias(k) for k in keys])
    return doubles.unpivot(["run_id"], keys, "key", "value")


def append_runs(metrics: DataFrame, path: str) -> None:
    metrics.select("run_id", "key", "value").write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def champion(versions: DataFrame, name="model_name") -> DataFrame:
    """The version promoted last, per model."""
    return versions.groupBy(name).agg(
        F.max_by("version", "promoted_at").alias("champion_version"),
        F.max("promoted_at").alias("promoted_at"),
    )


PART_SCHEMAS = {
    "trends": TREND_SCHEMA,
    "profile": "compute_type string, customer_segment string, day_of_week int, log_p10 double, log_p50 double, log_p90 double",
    "conformal": "compute_type string, adj double",
    "levels": "compute_type string, customer_segment string, series_level double, type_level double, segment_level double",
    "features": "position int, feature string",
    "base": "quantile string, base double, rounds int",
    "nodes": "quantile string, tree int, node int, feature int, threshold double, left int, right int, value double, gain double",
}


def write_parts(parts: dict[str, DataFrame], path: str) -> None:
    """Model parts as one table of JSON payloads: part, payload. A part's columns are those of its schema."""
    rows = None
    for name, frame in parts.items():
        row = frame.select(F.lit(name).alias("part"), F.to_json(F.struct(*_columns(name))).alias("payload"))
        rows = row if rows is None else rows.unionByName(row)
    rows.write.partitionBy("part").parquet(path)


def _columns(part):
    return [c.split()[0] for c in PART_SCHEMAS[part].split(", ")]


def load_parts(spark: SparkSession, path: str, wanted) -> dict[str, DataFrame]:
    """The wanted parts as tables, decoded with their declared schemas.

    A part that is not there raises a ValueError with its name; a payload that does not fit its schema stops the job.
    """
    rows = spark.read.schema("payload string, part string").parquet(path)
    there = {r["part"] for r in rows.select("part").distinct().collect()}  # a row per kind of part
    missing = [p for p in wanted if p not in there]
    if missing:
        raise ValueError(f"missing model parts: {missing}")
    decoded = lambda p: F.from_json("payload", PART_SCHEMAS[p], {"mode": "FAILFAST"})
    return {p: rows.filter(F.col("part") == p).select(decoded(p).alias("v")).select("v.*") for p in wanted}
