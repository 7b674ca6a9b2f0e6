"""Capped exponential trends per series and the residual around them."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeline.functions.exprs import clip
from surgeline.operators.features import first_date
from surgeline.schema import DATE, KEYS, TARGET

# Shipped growth cap per 30 days and residual limits.
MAX_MONTHLY_GROWTH = 0.06
RATIO_RANGE = (0.1, 10.0)


def daily_cap(monthly: float) -> float:
    return math.log(1 + monthly) / 30


def fit_trends(usage: DataFrame, cap=MAX_MONTHLY_GROWTH, keys=KEYS, target=TARGET, origin=None) -> DataFrame:
    """Log-linear fit per series on positive values; growth is limited from above only.

    ``origin`` defaults to the first date of the whole frame, shared by all series. A series with
    one usable day gets its level and no growth. ``cap=None`` leaves the slope as fitted.
    """
    start = first_date(usage) if origin is None else origin
    start = F.lit(start).cast("date") if isinstance(start, str) else start
    t = F.datediff(DATE, start).cast("double")
    log_y = F.ln(target)
    fitted = (
        usage.filter(F.col(target) > 0)
        .groupBy(*keys)
        .agg(
            F.regr_intercept(log_y, t).alias("_a"),
            F.regr_slope(log_y, t).alias("_b"),
            F.avg(log_y).alias("_level"),
        )
    )
    slope = F.coalesce("_b", F.lit(0.0))
    return fitted.select(
        *keys,
        F.coalesce("_a", "_level").alias("log_intercept"),
        (slope if cap is None else F.least(slope, F.lit(daily_cap(cap)))).alias("daily_growth_rate"),
        slope.alias("uncapped_rate"),
        start.alias("origin_date"),
    )


def trend_value(date=DATE):
    """exp(a + b * t) from trend columns on the same row."""
    t = F.datediff(date, "origin_date")
    return F.exp(F.col("log_intercept") + F.col("daily_growth_rate") * t)


def with_trend(df: DataFrame, trends: DataFrame, keys=KEYS) -> DataFrame:
    """Add ``trend``; a row whose series has no fitted trend stops the job."""
    joined = df.join(trends.drop("uncapped_rate"), list(keys), "left")
    problem = F.concat(F.lit("no fitted trend for series "), F.concat_ws(" | ", *keys))
    value = F.when(F.col("log_intercept").isNotNull(), trend_value()).otherwise(
        F.raise_error(problem).cast("double")
    )
    return joined.withColumn("trend", value).drop("log_intercept", "daily_growth_rate", "origin_date")


def with_ratio(df: DataFrame, target=TARGET, trend="trend") -> DataFrame:
    """Residual ratio actual / max(trend, 1), limited to the residual range."""
    raw = F.col(target) / F.greatest(F.col(trend), F.lit(1.0))
    return df.withColumn("ratio", clip(raw, *RATIO_RANGE))


def residual_ratios(df: DataFrame, trends: DataFrame, keys=KEYS, target=TARGET) -> DataFrame:
    return with_ratio(with_trend(df, trends, keys), target)


def rebuild(log_ratio, trend="trend"):
    """Real-scale value from a predicted log ratio; the trend is not floored here."""
    c = F.col(log_ratio) if isinstance(log_ratio, str) else log_ratio
    return F.col(trend) * F.exp(c)


def growth_rates(trends: DataFrame, keys=KEYS) -> DataFrame:
    """Monthly (30 days) and annual (365 days) growth of the uncapped fits."""
    b = F.col("uncapped_rate")
    return trends.select(
        *keys, F.expm1(b * 30).alias("monthly_rate"), F.expm1(b * 365).alias("annual_rate")
    )
