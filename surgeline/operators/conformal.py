"""Conformal interval calibration and the served forecast."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeline.functions.quantiles import exact_quantile, spread_out
from surgeline.schema import TARGET

TARGET_COVERAGE = 0.80


def conformal_level(coverage: float = TARGET_COVERAGE):
    """Finite-sample level: ceil((n + 1) * coverage) / n, at most 1."""
    return lambda n: F.least(F.ceil((n + 1) * F.lit(coverage)) / n, F.lit(1.0))


def conformity(df: DataFrame, target=TARGET) -> DataFrame:
    """Distance outside [p10, p90] as a share of max(p50, 1); negative inside the band."""
    outside = F.greatest(F.col("p10") - F.col(target), F.col(target) - F.col("p90"))
    score = F.when(
        F.col(target).isNotNull() & F.col("p10").isNotNull() & F.col("p90").isNotNull(),
        outside / F.greatest(F.col("p50"), F.lit(1.0)),
    )
    return df.withColumn("score", score)


def conformal_adjustments(
    df: DataFrame, by=("compute_type",), coverage=TARGET_COVERAGE, target=TARGET
) -> DataFrame:
    """Adjustment per type: ``by + [adj, n]``. May be negative, which narrows the band."""
    return exact_quantile(
        conformity(df, target), list(by), "score", conformal_level(coverage), coverage, out="adj"
    )


def apply_conformal(df: DataFrame, adjustments: DataFrame, by=("compute_type",)) -> DataFrame:
    """Shift both ends by adj * p50; a type without an adjustment keeps its band."""
    adj = F.coalesce(F.col("adj"), F.lit(0.0))
    return (
        df.join(spread_out(adjustments.select(*by, "adj")), list(by), "left")
        .withColumns({"p10": F.col("p10") - adj * F.col("p50"), "p90": F.col("p90") + adj * F.col("p50")})
        .drop("adj")
    )


def serve(df: DataFrame, adjustments: DataFrame, by=("compute_type",)) -> DataFrame:
    """Served output: calibrated, p10 not below zero, p10 <= p50 <= p90."""
    p50 = F.col("p50")
    has = p50.isNotNull()
    return apply_conformal(df, adjustments, by).withColumns(
        {
            "p10": F.when(has, F.least(F.greatest(F.col("p10"), F.lit(0.0)), p50)),
            "p90": F.when(has, F.greatest(F.col("p90"), p50)),
        }
    )
