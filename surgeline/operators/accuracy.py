"""Accuracy, coverage and comparison of forecasts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.functions.exprs import horizon_bucket
from surgeline.functions.quantiles import exact_quantile
from surgeline.schema import DATE, KEYS, QUANTILES, TARGET

# The three horizon rules as (rule, edges, labels, closed side, lowest included).
HORIZON_RULES = [
    ("right_open_start", [0, 7, 14, 30, 60, 90, 182],
     ["1-7d", "8-14d", "15-30d", "31-60d", "61-90d", "91-181d"], "right", False),
    ("right_with_start", [0, 30, 60, 90, 120, 181],
     ["Days 1-30", "Days 31-60", "Days 61-90", "Days 91-120", "Days 121-181"], "right", True),
    ("left", [0, 7, 14, 30, 60, 90, 120, 150, 181],
     ["Days 1-7", "Days 8-14", "Days 15-30", "Days 31-60", "Days 61-90", "Days 91-120",
      "Days 121-150", "Days 151-181"], "left", False),
]


def scored(df: DataFrame, pred="p50", target=TARGET) -> DataFrame:
    """Rows with both an actual and a prediction."""
    return df.filter(F.col(pred).isNotNull() & F.col(target).isNotNull())


def ape(pred="p50", target=TARGET):
    """Absolute error share; NULL (so left out of averages) where the actual is zero."""
    return F.abs(F.col(pred) - F.col(target)) / F.abs(F.nullif(F.col(target), F.lit(0.0)))


def mape(pred="p50", target=TARGET):
    return F.avg(ape(pred, target)) * 100


def mae(pred="p50", target=TARGET):
    return F.avg(F.abs(F.col(pred) - F.col(target)))


def rmse(pred="p50", target=TARGET):
    return F.sqrt(F.avg(F.pow(F.col(pred) - F.col(target), 2)))


def bias(pred="p50", target=TARGET):
    return F.avg((F.col(pred) - F.col(target)) / F.nullif(F.col(target), F.lit(0.0))) * 100


def coverage(low="p10", high="p90", target=TARGET):
    return F.avg((F.col(target).between(F.col(low), F.col(high))).cast("double")) * 100


def pinball(pred, alpha, target=TARGET):
    gap = F.col(target) - F.col(pred)
    return F.avg(F.greatest(gap * alpha, gap * (alpha - 1)))


def evaluate(df: DataFrame, preds: dict[str, str], target=TARGET) -> DataFrame:
    """MAE, RMSE, MAPE, bias and N of several prediction columns as (model, ...) rows.

    All models are measured in one aggregate over the frame and turned into rows afterwards.
    """
    both = lambda p: F.when(F.col(p).isNotNull() & F.col(target).isNotNull(), F.col(p))
    frame = df.select(F.col(target), *[both(p).alias(p) for p in preds.values()])
    names = {"mae": mae, "rmse": rmse, "mape": mape, "bias_pct": bias}
    wide = frame.agg(
        *[
            F.struct(
                F.lit(m).alias("model"),
                *[fn(p, target).alias(n) for n, fn in names.items()],
                F.count(p).alias("n"),
            ).alias(f"m{i}")
            for i, (m, p) in enumerate(preds.items())
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(preds))])))


def by_dims(df: DataFrame, aggs: dict, keys=KEYS) -> DataFrame:
    """Measures per (type, segment), per type, per segment and overall in one pass.

    ``grouping_level`` is 0 for the pair, 1 for the type alone, 2 for the segment alone, 3 overall.
    """
    ct, seg = (F.col(k) for k in keys)
    level = F.grouping_id(ct, seg).cast("int").alias("grouping_level")
    grouped = df.groupingSets([[ct, seg], [ct], [seg], []], ct, seg)
    return grouped.agg(level, *[c.alias(n) for n, c in aggs.items()])


def miss_direction(df: DataFrame, by=("compute_type",), target=TARGET) -> DataFrame:
    y = F.col(target)
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y > F.col("p90")).alias("above_p90"),
        F.count_if(y < F.col("p10")).alias("below_p10"),
    )
    n = F.col("n")
    return out.withColumns(
        {
            "above_share": F.col("above_p90") / n,
            "below_share": F.col("below_p10") / n,
            "coverage": (n - F.col("above_p90") - F.col("below_p10")) / n,
        }
    )


def with_residuals(df: DataFrame, pred="p50", target=TARGET) -> DataFrame:
    residual = F.col(target) - F.col(pred)
    return df.withColumns(
        {"residual": residual, "pct_error": residual / F.nullif(F.col(target), F.lit(0.0)) * 100}
    )


def residual_summary(df: DataFrame) -> DataFrame:
    """Percent-error statistics: overall median, mean/std per type, mean per weekday."""
    rows = with_residuals(df)
    median = exact_quantile(
        rows.withColumn("dimension", F.lit("overall")), ["dimension"], "pct_error", lambda n: F.lit(0.5), 0.5
    ).select("dimension", F.lit("all").alias("member"), F.lit("median").alias("statistic"), F.col("quantile").alias("value"))
    per_type = rows.groupBy("compute_type").agg(
        F.avg("pct_error").alias("mean"), F.stddev_samp("pct_error").alias("std")
    ).unpivot("compute_type", ["mean", "std"], "statistic", "value").select(
        F.lit("compute_type").alias("dimension"), F.col("compute_type").alias("member"), "statistic", "value"
    )
    per_day = rows.groupBy(F.date_format(DATE, "EEEE").alias("member")).agg(F.avg("pct_error").alias("value")).select(
        F.lit("day_of_week").alias("dimension"), "member", F.lit("mean").alias("statistic"), "value"
    )
    return median.unionByName(per_type).unionByName(per_day)


def horizon_accuracy(df: DataFrame, start, pred="p50", target=TARGET) -> DataFrame:
    """MAPE per horizon bucket under each of the three bucket rules."""
    days = F.datediff(DATE, F.lit(start).cast("date") if isinstance(start, str) else start)
    rows = df.withColumn("_days", days)
    labels = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                horizon_bucket("_days", edges, names, closed, lowest).alias("bucket"),
            )
            for rule, edges, names, closed, lowest in HORIZON_RULES
        ]
    )
    return (
        rows.select(pred, target, F.inline(labels))
        .filter(F.col("bucket").isNotNull())
        .groupBy("rule", "bucket")
        .agg(mape(pred, target).alias("mape"), F.count(F.lit(1)).alias("n"))
    )


def aggregated_accuracy(df: DataFrame, preds: list[str], target=TARGET) -> DataFrame:
    """Sum actuals and predictions per day, then score the daily totals."""
    daily = df.groupBy(DATE).agg(F.sum(target).alias(target), *[F.sum(p).alias(p) for p in preds])
    return daily.agg(*[mape(p, target).alias(f"mape_{p}") for p in preds], F.count(F.lit(1)).alias("n_days"))


def compare_models(df: DataFrame, first: str, second: str, keys=KEYS, target=TARGET) -> DataFrame:
    """Per-series MAPE of two prediction columns, the change and a flag at one point."""
    out = df.groupBy(*keys).agg(mape(first, target).alias("mape_first"), mape(second, target).alias("mape_second"))
    delta = F.col("mape_second") - F.col("mape_first")
    return out.withColumns(
        {
            "delta": delta,
            "flag": F.when(delta < -1, "better").when(delta > 1, "worse").otherwise("same"),
        }
    )


def compare_coverage(df: DataFrame, first, second, dim="compute_type", target=TARGET) -> DataFrame:
    """Coverage of two intervals, each given by its end columns, by member and over all."""
    out = df.rollup(dim).agg(
        F.grouping(dim).alias("_all"), coverage(*first, target).alias("coverage_first"), coverage(*second, target).alias("coverage_second"), F.count(F.lit(1)).alias("n")
    )
    name = F.when(F.col("_all") == 1, F.lit("all types")).otherwise(F.col(dim))
    delta = F.col("coverage_second") - F.col("coverage_first")
    return out.select(name.alias(dim), "coverage_first", "coverage_second", delta.alias("delta"), "n")


def pinball_losses(df: DataFrame, target=TARGET) -> DataFrame:
    return df.agg(*[pinball(n, a, target).alias(f"pinball_{n}") for n, a in QUANTILES.items()])


def edge_growth(train: DataFrame, keys=KEYS, target=TARGET, edge=30) -> DataFrame:
    """Daily growth per series from the means of its first and last ``edge`` training rows."""
    w = Window.partitionBy(*keys)
    ends = train.select(
        DATE, *keys, target,
        F.row_number().over(w.orderBy(DATE)).alias("_up"),
        F.row_number().over(w.orderBy(F.col(DATE).desc())).alias("_down"),
    )
    stats = ends.groupBy(*keys).agg(
        F.avg(F.when(F.col("_up") <= edge, F.col(target))).alias("_first"),
        F.avg(F.when(F.col("_down") <= edge, F.col(target))).alias("_last"),
        F.datediff(F.max(DATE), F.min(DATE)).alias("_days"),
    )
    rate = F.pow(F.col("_last") / F.nullif("_first", F.lit(0.0)), 1 / F.nullif(F.col("_days"), F.lit(0))) - 1
    return stats.select(*keys, rate.alias("daily_rate"))
