"""The whole recipe on one split or on many at once: trend, quantile profile, calibration, metrics.

A split is a column: ``role`` says whether a row is fitted on (``fit``), calibrated on (``val``) or scored (``test``).
With several folds the fold is one more grouping key, so all folds are fitted, calibrated and scored by the same jobs.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeline.operators import accuracy, conformal, profile, trend
from surgeline.schema import DATE, KEYS, TARGET
from surgeline.session import written


@dataclass
class Split:
    """What a recipe leaves behind: small tables of parameters, and scored rows."""

    trends: DataFrame
    profile: DataFrame
    adjustments: DataFrame
    validation: DataFrame
    test: DataFrame


def assign_role(rows: DataFrame, train_end, val_end, test_end=None) -> DataFrame:
    """One split by date: fit up to ``train_end``, val up to ``val_end``, test after it."""
    day = lambda d: F.lit(d).cast("date") if isinstance(d, str) else d
    out = rows.withColumn("role", F.when(F.col(DATE) <= day(train_end), "fit").when(F.col(DATE) <= day(val_end), "val").otherwise("test"))
    return out.filter(F.col(DATE) <= day(test_end)) if test_end else out


def assign_folds(rows: DataFrame, folds, val_days: int) -> DataFrame:
    """Rows once per fold they belong to: fold, train_end, test_end, role and the row.

    ``folds``: (name, end of training, end of test). The last ``val_days`` of a training window are its
    validation rows, so neither stopping nor calibration sees the fold's test rows.
    """
    listed = F.array(
        *[F.struct(F.lit(n).alias("fold"), F.lit(a).cast("date").alias("train_end"), F.lit(b).cast("date").alias("test_end")) for n, a, b in folds]
    )
    out = rows.select("*", F.inline(listed)).filter(F.col(DATE) <= F.col("test_end"))
    return out.withColumn("role", F.when(F.col(DATE) <= F.date_sub("train_end", val_days), "fit").when(F.col(DATE) <= F.col("train_end"), "val").otherwise("test"))


def fit_and_score(rows: DataFrame, by=(), origin=None, cap=trend.MAX_MONTHLY_GROWTH, coverage=conformal.TARGET_COVERAGE) -> Split:
    """Fit on ``fit``, calibrate on ``val``, score ``test``, within each group of ``by``.

    ``rows`` is read three times, so it should be a written table; the fitted tables are written once.
    """
    by = list(by)
    keys = [*by, *KEYS]
    fit = rows.filter("role = 'fit'")
    trends = written(trend.fit_trends(fit, cap, keys=keys, origin=origin), "split-trends")
    shape = written(profile.fit_profile(trend.residual_ratios(fit, trends, keys), by=keys), "split-profile")
    scored = written(profile.predict_profile(rows.filter("role IN ('val', 'test')"), trends, shape, by=keys), "split-scored")
    validation, test = scored.filter("role = 'val'"), scored.filter("role = 'test'")
    adjustments = written(conformal.conformal_adjustments(validation, by=(*by, "compute_type"), coverage=coverage), "split-conformal")
    return Split(trends, shape, adjustments, validation, conformal.apply_conformal(test, adjustments, by=(*by, "compute_type")))


def metrics(test: DataFrame, by=(), target=TARGET) -> DataFrame:
    """Error, bias and coverage of the calibrated interval, a row per group."""
    return test.groupBy(*by).agg(
        accuracy.mape("p50", target).alias("mape_p50"),
        accuracy.bias("p50", target).alias("bias_pct"),
        accuracy.coverage(target=target).alias("coverage_p10_p90"),
        accuracy.mae("p50", target).alias("mae"),
        accuracy.rmse("p50", target).alias("rmse"),
        F.count(F.lit(1)).alias("n_test_rows"),
    )


def fold_summary(per_fold: DataFrame, by, value="mape_p50") -> DataFrame:
    """Mean, deviation (over all folds, not a sample), range of a metric over the folds."""
    m = F.col(value)
    return per_fold.groupBy(*by).agg(
        F.avg(m).alias("mean_mape"), F.stddev_pop(m).alias("std_mape"), F.min(m).alias("min_mape"), F.max(m).alias("max_mape"),
        (F.max(m) - F.min(m)).alias("range_mape"),
    )
