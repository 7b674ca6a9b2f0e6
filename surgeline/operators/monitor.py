"""Monitoring of live forecasts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.functions.exprs import day_number
from surgeline.operators.accuracy import ape
from surgeline.schema import DATE, KEYS, TARGET


def rolling_mape(df: DataFrame, by=("compute_type",), days=28, pred="p50", target=TARGET) -> DataFrame:
    """MAPE over the last ``days`` calendar days per group.

    Errors are summed per day first, so the window runs over the calendar, not over the rows.
    """
    daily = df.groupBy(*by, DATE).agg(F.sum(ape(pred, target)).alias("_e"), F.count(ape(pred, target)).alias("_n"))
    w = Window.partitionBy(*by).orderBy(day_number()).rangeBetween(-(days - 1), 0)
    return daily.select(*by, DATE, (F.sum("_e").over(w) / F.sum("_n").over(w) * 100).alias("rolling_mape"))


def breaches(rolling: DataFrame, limit=15.0, min_days=7, by=("compute_type",)) -> DataFrame:
    """Stretches of at least ``min_days`` consecutive calendar days over the limit."""
    w = Window.partitionBy(*by).orderBy(DATE)
    over = rolling.filter(F.col("rolling_mape") > limit)
    island = day_number() - F.row_number().over(w)
    runs = over.select("*", island.alias("_island")).groupBy(*by, "_island").agg(
        F.min(DATE).alias("start_date"),
        F.max(DATE).alias("end_date"),
        F.count(F.lit(1)).alias("n_days"),
        F.max("rolling_mape").alias("worst_mape"),
    )
    return runs.filter(F.col("n_days") >= min_days).drop("_island")


def weekly_coverage(df: DataFrame, by=("compute_type",), limit=70.0, target=TARGET) -> DataFrame:
    covered = F.col(target).between(F.col("p10"), F.col("p90")).cast("double")
    out = df.groupBy(*by, F.trunc(DATE, "week").alias("week")).agg(
        F.avg(covered).alias("_c"), F.count(covered).alias("n")
    )
    pct = F.col("_c") * 100
    return out.select(*by, "week", "n", pct.alias("coverage_pct"), (pct < limit).cast("int").alias("needs_refresh"))


def sign_runs(df: DataFrame, by=KEYS, min_days=5, pred="p50", target=TARGET) -> DataFrame:
    """Stretches of residuals with one sign, in date order of the series."""
    sign = F.signum(F.col(target) - F.col(pred)).cast("int")
    w = Window.partitionBy(*by).orderBy(DATE)
    rows = df.select(*by, DATE, sign.alias("sign"))
    rows = rows.select("*", F.coalesce((F.lag("sign").over(w) != F.col("sign")).cast("int"), F.lit(1)).alias("_new"))
    rows = rows.select("*", F.sum("_new").over(w).alias("_run"))
    runs = rows.groupBy(*by, "_run", "sign").agg(
        F.min(DATE).alias("start_date"), F.max(DATE).alias("end_date"), F.count(F.lit(1)).alias("n_days")
    )
    return runs.filter((F.col("n_days") >= min_days) & (F.col("sign") != 0)).drop("_run")


def retrain_windows(usage: DataFrame, months=24) -> DataFrame:
    """For every month: the window of the months before it and the rows it would train on.

    Rows are counted per month first; the rolling window then runs over months, so no row is
    copied into the windows that use it.
    """
    per_month = usage.groupBy(F.trunc(DATE, "MM").alias("retrain_month")).agg(F.count(F.lit(1)).alias("_n"))
    index = F.year("retrain_month") * 12 + F.month("retrain_month")
    w = Window.partitionBy(F.lit(0)).orderBy(index).rangeBetween(-months, -1)
    return per_month.select(
        "retrain_month",
        F.add_months("retrain_month", -months).alias("window_start"),
        F.date_sub("retrain_month", 1).alias("window_end"),
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("n_rows"),
        F.count("_n").over(w).alias("n_months"),
    )
