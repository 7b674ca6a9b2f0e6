"""Business events: rolling up, exploding, measuring impact, and adjustment factors."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.functions.exprs import split_list
from surgeline.schema import DATE, KEYS, TARGET

EVENT = ["event_date", "event_end_date", "event_type", "event_name"]


def event_log(rows: DataFrame, magnitude_format: str) -> DataFrame:
    """One row per event from per-series event rows.

    Types and segments are distinct, sorted and joined with "; "; an event with any negative
    magnitude is a churn event. Distinct members are found by aggregation, so only short lists of
    members are gathered per event.
    """
    churn = F.min("magnitude") < 0
    per_event = rows.groupBy("event_date", "event_end_date", "event_type", "event_name").agg(
        F.array_join(F.sort_array(F.collect_set("compute_type")), "; ").alias("affected_compute_types"),
        F.array_join(F.sort_array(F.collect_set("customer_segment")), "; ").alias("affected_segments"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("compute_type", "customer_segment", "magnitude"))),
                lambda s: F.format_string(magnitude_format, s["magnitude"]),
            ),
            "; ",
        ).alias("magnitude"),
        churn.alias("_churn"),
    )
    return per_event.withColumn(
        "event_type", F.when(F.col("_churn"), F.lit("churn")).otherwise(F.col("event_type"))
    ).drop("_churn").orderBy("event_date", "event_name")


def explode_series(log: DataFrame) -> DataFrame:
    """Event by affected type and affected segment (every combination named in the row)."""
    return (
        log.withColumn("compute_type", F.explode(split_list("affected_compute_types")))
        .withColumn("customer_segment", F.explode(split_list("affected_segments")))
        .drop("affected_compute_types", "affected_segments")
    )


def on_dates(events: DataFrame, first, last) -> DataFrame:
    """One row per event and date of its window, so that the panel joins on equality."""
    return events.withColumn(DATE, F.explode(F.sequence(first, last)))


def step_change_impact(usage: DataFrame, log: DataFrame, days=30, target=TARGET) -> DataFrame:
    """Mean of the days before and from each step change, per affected series."""
    steps = explode_series(log.filter(F.col("event_type") == "step_change"))
    window = on_dates(steps, F.date_sub("event_date", days), F.date_add("event_date", days - 1))
    rows = window.join(usage, [DATE, *KEYS], "left")
    after = F.col(DATE) >= F.col("event_date")
    out = rows.groupBy("event_name", "event_date", *KEYS).agg(
        F.avg(F.when(~after, F.col(target))).alias("before_avg"),
        F.avg(F.when(after, F.col(target))).alias("after_avg"),
    )
    return out.withColumn(
        "change_pct", (F.col("after_avg") - F.col("before_avg")) / F.nullif("before_avg", F.lit(0.0)) * 100
    )


def outage_impact(daily_by_type: DataFrame, outages: DataFrame, margin=14, target=TARGET) -> DataFrame:
    """Average by phase (normal, outage, recovery) and share of the normal level.

    ``outages``: event_name, compute_type, outage_start, outage_end, recovery_end.
    """
    phase = (
        F.when(F.col(DATE) < F.col("outage_start"), "normal")
        .when(F.col(DATE) <= F.col("outage_end"), "outage")
        .otherwise("recovery")
    )
    window = on_dates(outages, F.date_sub("outage_start", margin), F.col("recovery_end"))
    rows = window.withColumn("phase", phase).join(daily_by_type, [DATE, "compute_type"])
    avg = {p: F.avg(F.when(F.col("phase") == p, F.col(target))).alias(p) for p in ("normal", "outage", "recovery")}
    wide = rows.groupBy("event_name", "compute_type").agg(*avg.values())
    long = wide.withColumn("_normal", F.col("normal")).unpivot(
        ["event_name", "compute_type", "_normal"], list(avg), "phase", "avg_hours"
    )
    return long.withColumn("share_of_normal", F.col("avg_hours") / F.col("_normal")).drop("_normal")


def spike_windows(usage: DataFrame, log: DataFrame, margin=10) -> DataFrame:
    """Panel rows of the affected series around each spike."""
    spikes = explode_series(log.filter(F.col("event_type") == "spike"))
    window = on_dates(spikes, F.date_sub("event_date", margin), F.date_add("event_end_date", margin))
    window = window.select("event_name", DATE, *KEYS, F.datediff(DATE, "event_date").alias("day_offset"))
    return window.join(usage, [DATE, *KEYS]).select("event_name", DATE, *KEYS, "day_offset", TARGET)
