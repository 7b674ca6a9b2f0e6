"""Recursive forecasts: each day's P50 becomes the next day's lag."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeline.operators.accuracy import mape
from surgeline.operators.boosting import MISSING, encode, walk
from surgeline.operators.features import with_calendar, with_holidays, with_trend_feature
from surgeline.operators.trend import with_trend
from surgeline.schema import DATE, KEYS, LAGS, TARGET, WINDOWS

HISTORY_DAYS = max(LAGS)
SERIES_PER_TASK = 64


def static_features(horizon: DataFrame, holidays: DataFrame, trends: DataFrame, levels: DataFrame, origin, by=()) -> DataFrame:
    """Everything about a future row that does not depend on forecasts."""
    rows = with_holidays(with_calendar(with_trend_feature(horizon, origin)), holidays)
    return encode(with_trend(rows, trends, [*by, *KEYS]), levels, by=by)


def recursive_forecast(
    usage: DataFrame,
    horizon: DataFrame,
    model,
    start: str,
    days: int,
    series_per_task: int = SERIES_PER_TASK,
    variant=None,
    target=TARGET,
) -> DataFrame:
    """Day-by-day forecast of all series: date, keys, one column per quantile.

    ``horizon`` comes from ``static_features``. Series are independent of each other, so they are
    spread over tasks in blocks of about ``series_per_task``; a block holds one year of history and
    the horizon of its series, and walks the days once for all of them together. Days of the horizon that a series lacks
    are left out of its forecast and are missing for the lags of later days. A value before ``start`` is the actual one.

    With ``variant``, a column of ``horizon`` (a growth cap, say), ``model`` maps its values, as text, to models and the walk goes
    once per series and variant, all in one job; ``usage`` may have the column too, else all variants share it.
    """
    extra = [variant] if variant else []
    keys = [*extra, *KEYS]
    models = model if variant else {"only": model}
    first = next(iter(models.values()))
    static = [c for c in first.features if not c.startswith(("lag_", "rolling_"))]
    start_date = F.lit(start).cast("date")
    recent = usage.filter((F.col(DATE) < start_date) & (F.col(DATE) >= F.date_sub(start_date, HISTORY_DAYS)))
    if variant and variant not in usage.columns:
        recent = recent.join(F.broadcast(horizon.select(variant).distinct()))  # a row per model
    known = recent.select(
        *keys, F.datediff(DATE, start_date).alias("day"), F.col(target).alias("value"),
        F.lit(None).cast("double").alias("trend"), F.lit(None).cast("array<double>").alias("static"),
    )
    inside = horizon.filter(F.datediff(DATE, start_date).between(0, days - 1))
    ahead = inside.select(
        *keys, F.datediff(DATE, start_date).alias("day"), F.lit(None).cast("double").alias("value"),
        "trend", F.array(*[F.col(c).cast("double") for c in static]).alias("static"),
    )
    n_series = horizon.select(*KEYS).distinct().count()
    blocks = max(1, -(-n_series // series_per_task))
    rows = known.unionByName(ahead).withColumn("block", F.pmod(F.xxhash64(*KEYS), F.lit(blocks)))

    shipped = usage.sparkSession.sparkContext.broadcast({v: (m.compiled(), m.depth()) for v, m in models.items()})
    features, names = list(first.features), list(first.base)

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        future = pdf["static"].notna().to_numpy()
        if not future.any():
            return pdf[keys].iloc[:0].assign(day=np.empty(0, np.int32), **{n: np.empty(0) for n in names})
        compiled, depth = shipped.value[str(pdf[variant].iloc[0]) if variant else "only"]
        codes, ids = pd.factorize(pd.MultiIndex.from_frame(pdf[keys].astype(object)))
        day = pdf["day"].to_numpy()
        value = np.full((len(ids), HISTORY_DAYS + days), np.nan)
        value[codes[~future], day[~future] + HISTORY_DAYS] = pdf["value"].to_numpy(float)[~future]
        trend = np.full((len(ids), days), np.nan)
        trend[codes[future], day[future]] = pdf["trend"].to_numpy(float)[future]
        fixed = np.zeros((len(ids), days, len(static)))
        fixed[codes[future], day[future]] = np.vstack(pdf["static"][future].to_numpy())
        out = {n: np.full((len(ids), days), np.nan) for n in names}
        x = np.empty((len(ids), len(features)))
        slots = [features.index(c) for c in static]
        for d in range(days):
            now = HISTORY_DAYS + d
            x[:, slots] = fixed[:, d]
            for j, c in enumerate(features):
                if c.startswith("lag_"):
                    x[:, j] = value[:, now - int(c[4:])]
            for w in WINDOWS:
                _rolling(value[:, now - w:now], w, features, x)
            block = np.where(np.isnan(x), MISSING, x)
            for n in names:
                out[n][:, d] = np.maximum(trend[:, d] * np.exp(walk(block, compiled[n], depth)), 0.0)
            value[:, now] = out["p50"][:, d]
        s, d = np.nonzero(~np.isnan(trend))
        frame = {k: ids.get_level_values(i).to_numpy()[s] for i, k in enumerate(keys)}
        return pd.DataFrame({**frame, "day": d, **{n: out[n][s, d] for n in names}})

    key_types = dict(horizon.dtypes)
    schema = ", ".join([f"{k} {key_types[k]}" for k in keys] + ["day int"] + [f"{n} double" for n in names])
    done = rows.groupBy(*extra, "block").applyInPandas(forecast, schema)
    return done.select(F.date_add(start_date, F.col("day")).alias(DATE), *keys, *names)


def _rolling(window, w, features, x):
    """Mean and sample deviation of the values present; missing where there are none (or one)."""
    present = ~np.isnan(window)
    n = present.sum(axis=1)
    filled = np.where(present, window, 0.0)
    mean = np.divide(filled.sum(axis=1), n, out=np.full(len(n), np.nan), where=n > 0)
    off = np.where(present, window - np.where(n > 0, mean, 0.0)[:, None], 0.0)
    var = np.divide((off**2).sum(axis=1), n - 1, out=np.full(len(n), np.nan), where=n > 1)
    for name, v in ((f"rolling_mean_{w}", mean), (f"rolling_std_{w}", np.sqrt(var))):
        if name in features:
            x[:, features.index(name)] = v


def compared(recursive: DataFrame, single: DataFrame, actual: DataFrame, by=(), target=TARGET) -> DataFrame:
    """Rows with a positive actual and both forecasts: ``recursive`` and ``single``."""
    rows = actual.filter(F.col(target).isNotNull() & (F.col(target) > 0)).select(DATE, *KEYS, *[b for b in by if b in actual.columns], target)
    keys = [DATE, *KEYS, *by]
    both = recursive.select(*keys, F.col("p50").alias("recursive")).join(single.select(*keys, F.col("p50").alias("single")), keys)
    return rows.join(both, [c for c in rows.columns if c != target])


def degradation(rows: DataFrame, by=(), target=TARGET) -> DataFrame:
    """MAPE of both forecasts per group of ``compared`` rows, and the difference in points."""
    return rows.groupBy(*by).agg(
        mape("single", target).alias("single_step_mape"),
        mape("recursive", target).alias("recursive_mape"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("degradation_points", F.col("recursive_mape") - F.col("single_step_mape"))


def cap_verdict(per_cap: DataFrame, old_cap: float, new_cap: float, band=0.5) -> DataFrame:
    """Does the accuracy cost of a tighter cap grow when forecasts feed on themselves?

    A gap of exactly ``band`` points is still similar.
    """
    def at(c, cap):
        return F.max(F.when(F.abs(F.col("cap") - cap) < 1e-9, F.col(c)))

    costs = per_cap.agg(
        (at("single_step_mape", old_cap) - at("single_step_mape", new_cap)).alias("single_step_cost"),
        (at("recursive_mape", old_cap) - at("recursive_mape", new_cap)).alias("recursive_cost"),
    )
    gap = F.col("recursive_cost") - F.col("single_step_cost")
    return costs.withColumn(
        "verdict", F.when(gap > band, "compounds").when(gap < -band, "absorbed").otherwise("similar")
    )
