"""Weekday-profile quantile model.

A closed-form quantile model: quantiles of the log residual ratio per series and weekday. It is
simpler than boosted trees and fully checkable in SQL; ``boosting`` holds the learned model.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeline.operators.trend import rebuild, with_trend
from surgeline.schema import DATE, KEYS, QUANTILES


def fit_profile(ratios: DataFrame, by=KEYS) -> DataFrame:
    """One row per group and weekday; a group holds at most one value per week of history."""
    levels = F.array(*[F.lit(q) for q in QUANTILES.values()])
    out = ratios.groupBy(*by, F.weekday(DATE).alias("day_of_week")).agg(
        F.percentile(F.ln("ratio"), levels).alias("_q")
    )
    return out.select(
        *by, "day_of_week", *[F.col("_q")[i].alias(f"log_{n}") for i, n in enumerate(QUANTILES)]
    )


def predict_profile(df: DataFrame, trends: DataFrame, profile: DataFrame, by=KEYS) -> DataFrame:
    """Add ``trend`` and p10/p50/p90, floored at zero."""
    rows = with_trend(df, trends, by).withColumn("day_of_week", F.weekday(DATE))
    rows = rows.join(profile, [*by, "day_of_week"], "left")
    cols = {n: F.greatest(rebuild(f"log_{n}"), F.lit(0.0)) for n in QUANTILES}
    # a weekday never seen in training has no profile and must stay NULL
    cols = {n: F.when(F.col(f"log_{n}").isNotNull(), c) for n, c in cols.items()}
    return rows.withColumns(cols).drop("day_of_week", *[f"log_{n}" for n in QUANTILES])
