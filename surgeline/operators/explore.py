"""Exploratory statistics over a usage panel."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.functions.quantiles import exact_quantile
from surgeline.schema import DATE, KEYS, TARGET

DAYS_PER_MONTH = 30.44


def totals(usage: DataFrame, *dims, target=TARGET) -> DataFrame:
    """Sum of the target per date and the given dimensions."""
    return usage.groupBy(DATE, *dims).agg(F.sum(target).alias(target))


def summary(usage: DataFrame, keys=KEYS, target=TARGET) -> DataFrame:
    """Rows, span, distinct counts and total, one row."""
    per_series = usage.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_s"),
        F.min(DATE).alias("_d0"), F.max(DATE).alias("_d1"),
    )
    # distinct dates are counted on their own partial aggregate, not by expanding every row
    days = usage.select(DATE).distinct().agg(F.count(F.lit(1))).scalar()
    return per_series.agg(
        F.sum("_n").alias("n_rows"),
        F.min("_d0").alias("first_date"),
        F.max("_d1").alias("last_date"),
        F.count(F.lit(1)).alias("n_series"),
        F.countDistinct(keys[0]).alias("n_types"),
        F.countDistinct(keys[1]).alias("n_segments"),
        F.sum("_s").alias("total_hours"),
    ).withColumn("n_days", days)


def quality_profile(usage: DataFrame, target=TARGET) -> DataFrame:
    y = F.col(target)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in usage.columns]
    return usage.agg(
        *nulls,
        F.count_if(y == 0).alias("zero_rows"),
        F.count_if(y < 0).alias("negative_rows"),
        F.count(y).alias("n"),
        F.avg(y).alias("mean"),
        F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"),
        F.max(y).alias("max"),
    )


def null_counts(features: DataFrame, columns) -> DataFrame:
    wide = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "null_count")


def monthly_mix(usage: DataFrame, dim="compute_type", target=TARGET) -> DataFrame:
    """Share of each member in its month, in percent, long form."""
    month = F.trunc(DATE, "MM").alias("month")
    parts = usage.groupBy(month, dim).agg(F.sum(target).alias("hours"))
    return parts.withColumn(
        "pct", F.col("hours") / F.sum("hours").over(Window.partitionBy("month")) * 100
    )


def growth(daily: DataFrame, by=(), target=TARGET, edge=30) -> DataFrame:
    """First versus last ``edge`` days: multiple, compound monthly rate, annualised rate.

    Edges are found by date rank; ``daily`` has one row per date and group.
    """
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ranked = daily.select(
        *by, DATE, target,
        F.row_number().over(part.orderBy(DATE)).alias("_up"),
        F.row_number().over(part.orderBy(F.col(DATE).desc())).alias("_down"),
    )
    stats = ranked.groupBy(*by).agg(
        F.avg(F.when(F.col("_up") <= edge, F.col(target))).alias("first_mean"),
        F.avg(F.when(F.col("_down") <= edge, F.col(target))).alias("last_mean"),
        (F.datediff(F.max(DATE), F.min(DATE)) / DAYS_PER_MONTH).alias("months"),
    )
    multiple = F.col("last_mean") / F.nullif("first_mean", F.lit(0.0))
    monthly = F.pow(multiple, 1 / F.nullif("months", F.lit(0.0))) - 1
    return stats.withColumns(
        {"multiple": multiple, "monthly_cagr": monthly, "annualized": F.pow(monthly + 1, 12) - 1}
    )


def dow_profile(usage: DataFrame, dim="compute_type", target=TARGET) -> DataFrame:
    """Mean per weekday relative to the mean of the whole member."""
    parts = usage.groupBy(dim, F.date_format(DATE, "EEEE").alias("day_name")).agg(
        F.sum(target).alias("_s"), F.count(target).alias("_n")
    )
    # the overall mean comes from the seven partial sums, so the panel is read once
    whole = Window.partitionBy(dim)
    mean = F.col("_s") / F.col("_n")
    overall = F.sum("_s").over(whole) / F.sum("_n").over(whole)
    return parts.select(dim, "day_name", mean.alias("mean_hours"), (mean / overall).alias("relative"))


def centered(by, size=28):
    """Frame of ``size`` rows around the current one: size/2 back, size/2 - 1 ahead."""
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(DATE)
    return w.rowsBetween(-(size // 2), size - size // 2 - 1)


def with_centered_mean(df: DataFrame, by=(), target=TARGET, size=28) -> DataFrame:
    """Centered moving average and ratio to it; NULL unless the frame is full."""
    frame = centered(by, size)
    full = F.count(target).over(frame) == size
    ma = F.when(full, F.avg(target).over(frame))
    return df.select("*", ma.alias("ma")).withColumn("detrended", F.col(target) / F.nullif("ma", F.lit(0.0)))


def with_outliers(usage: DataFrame, by=KEYS, target=TARGET, size=28, limit=2.5) -> DataFrame:
    """z-score against the centered window; rows without a full window are no outliers."""
    frame = centered(by, size)
    full = F.count(target).over(frame) == size
    cols = [
        F.when(full, F.avg(target).over(frame)).alias("ma"),
        F.when(full, F.stddev_samp(target).over(frame)).alias("sd"),
    ]
    z = (F.col(target) - F.col("ma")) / F.nullif("sd", F.lit(0.0))
    return usage.select("*", *cols).withColumn("z", z).withColumn(
        "is_outlier", F.coalesce(F.abs("z") > limit, F.lit(False)).cast("int")
    )


def month_profile(daily: DataFrame, target=TARGET) -> DataFrame:
    """Average detrended level per calendar month."""
    rows = with_centered_mean(daily, (), target)
    return rows.groupBy(F.month(DATE).alias("month")).agg(F.avg("detrended").alias("level"))


def volatility(usage: DataFrame, by=KEYS, target=TARGET) -> DataFrame:
    """Coefficient of variation of each detrended series."""
    rows = with_centered_mean(usage, by, target)
    return rows.groupBy(*by).agg((F.stddev_samp("detrended") / F.avg("detrended")).alias("cv"))


MEMBERS = 200  # members of a dimension that are turned into columns, at most


def quartiles(df: DataFrame, value=TARGET) -> DataFrame:
    """Lower quartile, median and upper quartile as (statistic, value) rows."""
    rows = df.select(F.lit("all").alias("_all"), F.col(value).alias("_v"))
    found = [
        exact_quantile(rows, ["_all"], "_v", lambda n, q=q: F.lit(q), q).select(F.lit(name).alias("statistic"), F.col("quantile").alias("value"))
        for name, q in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def type_correlation(daily: DataFrame, dim="compute_type", target=TARGET) -> DataFrame:
    """Correlation of every pair of members, raw and detrended, over complete dates.

    The members are those of the data: meant for a dimension of few members, since the result has a
    row for each pair. Members become columns, so all pairs come from one aggregate; a dimension with more than ``MEMBERS`` is refused.
    """
    members = sorted(r[0] for r in daily.select(dim).distinct().limit(MEMBERS + 2).collect() if r[0] is not None)
    if len(members) > MEMBERS:
        raise ValueError(f"{dim} has more than {MEMBERS} members")
    rows = with_centered_mean(daily, (dim,), target)
    wide = rows.groupBy(DATE).pivot(dim, list(members)).agg(
        F.first(target).alias("raw"), F.first("detrended").alias("flat")
    )
    whole = None
    for m in members:
        present = F.col(f"`{m}_flat`").isNotNull()
        whole = present if whole is None else whole & present
    pairs = [(a, b) for i, a in enumerate(members) for b in members[i:]]

    def flat(m):
        return F.when(whole, F.col(f"`{m}_flat`"))

    cols = [
        F.struct(
            F.lit(a).alias("type_a"), F.lit(b).alias("type_b"),
            F.corr(f"`{a}_raw`", f"`{b}_raw`").alias("raw_corr"),
            F.corr(flat(a), flat(b)).alias("detrended_corr"),
        ).alias(f"p{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.agg(*cols).select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(pairs))])))


def histogram(usage: DataFrame, bins=50, dim="compute_type", part="customer_segment", target=TARGET) -> DataFrame:
    """Equal-width bins between each type's extremes; density per segment within the type."""
    edges = usage.groupBy(dim).agg(F.min(target).alias("_lo"), F.max(target).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    # the top edge belongs to the last bin
    slot = F.least(
        F.floor((F.col(target) - F.col("_lo")) / F.nullif("_width", F.lit(0.0))), F.lit(bins - 1)
    )
    counts = (
        usage.join(edges.withColumn("_width", width), dim)
        .withColumn("bin", F.coalesce(slot, F.lit(0)).cast("int"))
        .groupBy(dim, part, "bin", "_lo", "_width")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(dim, part))
    return counts.select(
        dim, part, "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        "n",
        (F.col("n") / (total * F.nullif("_width", F.lit(0.0)))).alias("density"),
    )


def holiday_impact(usage: DataFrame, holidays: DataFrame, dim="customer_segment", target=TARGET) -> DataFrame:
    """Holiday versus normal weekday mean per segment."""
    marks = holidays.select(DATE, F.lit(True).alias("_h")).distinct()
    rows = usage.filter(F.weekday(DATE) < 5).join(marks, DATE, "left")
    out = rows.groupBy(dim).agg(
        F.avg(F.when(F.col("_h").isNull(), F.col(target))).alias("normal_weekday"),
        F.avg(F.when(F.col("_h"), F.col(target))).alias("holiday"),
    )
    return out.withColumn("impact_pct", (F.col("holiday") / F.col("normal_weekday") - 1) * 100)


def autocorrelation(df: DataFrame, lags, by=(), value=TARGET) -> DataFrame:
    """r_k per series for lags 1..lags, long form with the series length.

    Lagged values come from one window, so the data crosses the network once however many lags.
    """
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    w = part.orderBy(DATE)
    rows = df.filter(F.col(value).isNotNull()).select(
        *by, DATE, (F.col(value) - F.avg(value).over(part)).alias("_d")
    )
    rows = rows.select("*", *[F.lag("_d", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = rows.groupBy(*by).agg(
        F.count("_d").alias("n"),
        F.sum(F.col("_d") * F.col("_d")).alias("_c0"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_c{k}") for k in range(1, lags + 1)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), (F.col(f"_c{k}") / F.nullif("_c0", F.lit(0.0))).alias("acf"))
            for k in range(1, lags + 1)
        ]
    )
    return sums.select(*by, "n", F.inline(pairs))


def ljung_box(acf: DataFrame, at=(7, 14, 28), by=()) -> DataFrame:
    """Q statistic n(n+2) * sum r_k^2 / (n-k) up to each of the given lags."""
    term = F.pow("acf", 2) / (F.col("n") - F.col("lag"))
    sums = acf.groupBy(*by, "n").agg(
        *[F.sum(F.when(F.col("lag") <= m, term)).alias(f"_s{m}") for m in at]
    )
    scale = F.col("n") * (F.col("n") + 2)
    rows = F.array(
        *[F.struct(F.lit(m).alias("max_lag"), (scale * F.col(f"_s{m}")).alias("statistic")) for m in at]
    )
    return sums.select(*by, "n", F.inline(rows))


def dickey_fuller(df: DataFrame, by=(), value=TARGET) -> DataFrame:
    """t statistic of the lagged level in the regression of the daily change on it.

    Unaugmented, with a constant; no lag search and no p-value.
    """
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(DATE)
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("_y"), F.lag(value).over(w).alias("_x"))
    rows = rows.filter(F.col("_x").isNotNull()).withColumn("_dy", F.col("_y") - F.col("_x"))
    fit = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("_dy", "_x").alias("slope"),
        F.regr_sxx("_dy", "_x").alias("_sxx"),
        F.regr_syy("_dy", "_x").alias("_syy"),
        F.regr_sxy("_dy", "_x").alias("_sxy"),
    )
    rss = F.col("_syy") - F.col("slope") * F.col("_sxy")
    se = F.sqrt(rss / (F.col("n") - 2) / F.col("_sxx"))
    return fit.select(*by, "n", "slope", (F.col("slope") / F.nullif(se, F.lit(0.0))).alias("t_stat"))


def classical_decomposition(daily: DataFrame, by=(), target=TARGET, period=7) -> DataFrame:
    """Additive decomposition: centered mean, weekday effect, remainder.

    Moving averages, not Loess. Weekday effects are centered to sum to zero.
    """
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(DATE)
    frame = w.rowsBetween(-(period // 2), period // 2)
    full = F.count(target).over(frame) == period
    rows = daily.select(
        *by, DATE, target, F.weekday(DATE).alias("_dow"),
        F.when(full, F.avg(target).over(frame)).alias("trend"),
    )
    effect = rows.groupBy(*by, "_dow").agg(F.avg(F.col(target) - F.col("trend")).alias("_raw"))
    mean = F.avg("_raw").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    effect = effect.select(*by, "_dow", (F.col("_raw") - mean).alias("seasonal"))
    return (
        rows.join(effect, [*by, "_dow"], "left")
        .drop("_dow")
        .withColumn("resid", F.col(target) - F.col("trend") - F.col("seasonal"))
    )


def decomposition_shares(parts: DataFrame, by=()) -> DataFrame:
    """Share of trend, seasonal and remainder variance in their sum."""
    v = parts.groupBy(*by).agg(
        F.var_samp("trend").alias("_t"), F.var_samp("seasonal").alias("_s"), F.var_samp("resid").alias("_r")
    )
    total = F.col("_t") + F.col("_s") + F.col("_r")
    return v.select(
        *by,
        (F.col("_t") / total).alias("trend_share"),
        (F.col("_s") / total).alias("seasonal_share"),
        (F.col("_r") / total).alias("resid_share"),
    )


def partial_autocorrelation(acf: DataFrame, by) -> DataFrame:
    """Yule-Walker partial autocorrelation from an ACF table; each group is one short lag list."""
    import numpy as np
    import pandas as pd

    by = list(by)
    schema = acf.select(*by, "lag", F.col("acf").alias("pacf")).schema

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = np.concatenate([[1.0], pdf["acf"].to_numpy(dtype=float)])
        out = []
        for k in range(1, len(r)):
            toeplitz = r[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
            out.append(np.linalg.solve(toeplitz, r[1 : k + 1])[-1])
        return pdf[[*by, "lag"]].assign(pacf=out)

    return acf.groupBy(*by).applyInPandas(solve, schema)
