"""Capacity scenarios, ceilings, crossings, shortfall and sensitivity."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.functions.exprs import half_even_thousands
from surgeline.schema import DATE, KEYS, QUANTILES, TARGET

# Spread of pipeline hours over the quantiles, efficiency gain, ceiling head-room, price.
DEAL_SPREAD = {"p10": 0.7, "p50": 1.0, "p90": 1.3}
EFFICIENCY = 0.85
HEADROOM_MEAN = 1.25
HEADROOM_PEAK = 1.15
SPOT_RATE = 2.50
DAYS_PER_COST_MONTH = 30
SCENARIOS = ["base", "high", "low"]


def with_deal_hours(forecast: DataFrame, deals: DataFrame, hours, keys=KEYS, out="deal_hours") -> DataFrame:
    """Hours of all deals that have started by the row's date; several deals add up.

    Deals are summed per series and start date and then accumulated along the series, so a series
    with many deals never multiplies its forecast rows.
    """
    starts = deals.groupBy(*keys, F.col("expected_date").alias(DATE)).agg(F.sum(hours).alias("_h"))
    rows = forecast.withColumn("_h", F.lit(0.0)).withColumn("_row", F.lit(True))
    both = rows.unionByName(starts.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy(DATE).rangeBetween(Window.unboundedPreceding, 0)
    return both.withColumn(out, F.sum("_h").over(so_far)).filter("_row").drop("_h", "_row")


def high_scenario(forecast: DataFrame, deals: DataFrame, keys=KEYS) -> DataFrame:
    """Probability-weighted pipeline hours on top of each quantile."""
    weighted = F.col("estimated_daily_hours") * F.col("probability")
    rows = with_deal_hours(forecast, deals, weighted, keys)
    return rows.withColumns(
        {f"high_{q}": F.col(q) + F.col("deal_hours") * s for q, s in DEAL_SPREAD.items()}
    ).drop("deal_hours")


def low_scenario(forecast: DataFrame, compute_type: str, start: str, factor=EFFICIENCY) -> DataFrame:
    """Efficiency gain on one type from a date on."""
    hit = (F.col("compute_type") == compute_type) & (F.col(DATE) >= F.lit(start).cast("date"))
    return forecast.withColumns(
        {f"low_{q}": F.when(hit, F.col(q) * factor).otherwise(F.col(q)) for q in QUANTILES}
    )


def scenarios(forecast, deals, compute_type, start, keys=KEYS) -> DataFrame:
    out = low_scenario(high_scenario(forecast, deals, keys), compute_type, start)
    return out.withColumns({f"base_{q}": F.col(q) for q in QUANTILES})


def scenario_daily(rows: DataFrame) -> DataFrame:
    """Nine daily totals: three scenarios by three quantiles."""
    return rows.groupBy(DATE).agg(*[F.sum(f"{s}_{q}").alias(f"{s}_{q}") for s in SCENARIOS for q in QUANTILES])


def scenario_long(daily: DataFrame) -> DataFrame:
    cols = [f"{s}_{q}" for s in SCENARIOS for q in QUANTILES]
    long = daily.unpivot([DATE], cols, "measure", "value")
    part = F.split("measure", "_")
    return long.select(DATE, part[0].alias("scenario"), part[1].alias("quantile"), "value")


def monthly_scenarios(daily: DataFrame) -> DataFrame:
    cols = [f"{s}_{q}" for s in SCENARIOS for q in ("p50", "p90")]
    return daily.groupBy(F.trunc(DATE, "MM").alias("month")).agg(*[F.bround(F.avg(c), 0).alias(c) for c in cols])


def monthly_envelope(forecast: DataFrame) -> DataFrame:
    """Mean, least and largest daily total per month and quantile."""
    daily = forecast.groupBy(DATE).agg(*[F.sum(q).alias(q) for q in QUANTILES])
    aggs = []
    for q in QUANTILES:
        aggs += [F.avg(q).alias(f"{q}_avg"), F.min(q).alias(f"{q}_min"), F.max(q).alias(f"{q}_max")]
    return daily.groupBy(F.date_format(DATE, "MMM yyyy").alias("month_name")).agg(*aggs)


def capacity_ceiling(usage: DataFrame, since: str, until: str, target=TARGET) -> DataFrame:
    """Mean and peak daily total since a date, and the two ceilings derived from them."""
    recent = usage.filter(F.col(DATE).between(F.lit(since).cast("date"), F.lit(until).cast("date")))
    daily = recent.groupBy(DATE).agg(F.sum(target).alias("_t"))
    mean, peak = F.avg("_t"), F.max("_t")
    return daily.agg(
        mean.alias("recent_avg"),
        peak.alias("recent_peak"),
        half_even_thousands(mean * HEADROOM_MEAN).alias("ceiling_mean"),
        half_even_thousands(peak * HEADROOM_PEAK).alias("ceiling_peak"),
    )


def ceiling_crossings(long: DataFrame, ceiling, start: str, by=("scenario", "quantile")) -> DataFrame:
    """First date at or over the ceiling, days from the start, percent of days over; NULL if never."""
    over = F.col("value") >= F.col("_ceiling")
    out = long.withColumn("_ceiling", ceiling).groupBy(*by).agg(
        F.min(F.when(over, F.col(DATE))).alias("crossing_date"),
        (F.count_if(over) / F.count(F.lit(1)) * 100).alias("pct_days_over"),
    )
    return out.withColumn("days_from_start", F.datediff("crossing_date", F.lit(start).cast("date")))


def shortfall(value="value", ceiling="_ceiling"):
    return F.avg(F.greatest(F.col(value) - F.col(ceiling), F.lit(0.0)))


def monthly_cost(c):
    return c * DAYS_PER_COST_MONTH * SPOT_RATE


def monthly_shortfall(long: DataFrame, ceiling, by=("scenario",)) -> DataFrame:
    """Average daily hours over the ceiling per month and their monthly cost."""
    out = long.withColumn("_ceiling", ceiling).groupBy(*by, F.trunc(DATE, "MM").alias("month")).agg(shortfall().alias("shortfall"))
    return out.withColumn("monthly_cost", monthly_cost(F.col("shortfall")))


def period_shortfall(long: DataFrame, ceiling, first: str, last: str, by=("scenario",)) -> DataFrame:
    """Average daily hours over the ceiling within a period and their monthly cost."""
    inside = long.filter(F.col(DATE).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    out = inside.withColumn("_ceiling", ceiling).groupBy(*by).agg(shortfall().alias("shortfall"))
    return out.withColumn("monthly_cost", monthly_cost(F.col("shortfall")))


# Sensitivity variants besides the deals.
GROWTH_VARIANTS = [("Growth +10%", 1.10), ("Growth -10%", 0.90)]
EFFICIENCY_VARIANTS = [("Efficiency 10%", 0.90), ("Efficiency 20%", 0.80)]


def sensitivity_paths(forecast, deals, compute_type, efficiency_start, start, keys=KEYS) -> DataFrame:
    """Daily P90 total under every variant: (parameter, category, date, value).

    Only daily totals are varied. Growth and efficiency variants are a fixed list laid over each
    day; a deal, known by its full name, is laid over the days of the horizon.
    """
    at_start = F.lit(start).cast("date")
    gain = (F.col("compute_type") == compute_type) & (F.col(DATE) >= F.lit(efficiency_start).cast("date"))
    daily = forecast.groupBy(DATE).agg(
        F.sum("p90").alias("_total"),
        F.coalesce(F.sum(F.when(gain, F.col("p90"))), F.lit(0.0)).alias("_gain_part"),
    )
    days_out = F.greatest(F.datediff(DATE, at_start), F.lit(0))
    total = F.col("_total")
    variants = [("Base P90", "Base", total)]
    variants += [(n, "Growth", total * F.pow(F.lit(m), days_out / 365)) for n, m in GROWTH_VARIANTS]
    variants += [(n, "Efficiency", total - F.col("_gain_part") * (1 - e)) for n, e in EFFICIENCY_VARIANTS]
    listed = F.array(
        *[F.struct(F.lit(n).alias("parameter"), F.lit(c).alias("category"), v.alias("value")) for n, c, v in variants]
    )
    fixed = daily.select(DATE, F.inline(listed))
    # every deal meets every day of the horizon, whether or not its series is forecast; a deal on a
    # series without a forecast changes nothing
    known = forecast.select(*keys).distinct().withColumn("_known", F.lit(True))
    planned = deals.join(known, list(keys), "left")
    added = F.when(F.col("_known") & (F.col(DATE) >= F.col("expected_date")), F.col("estimated_daily_hours")).otherwise(0.0)
    horizon = F.sequence(daily.agg(F.min(DATE)).scalar(), daily.agg(F.max(DATE)).scalar())
    days = planned.withColumn(DATE, F.explode(horizon))
    per_deal = days.join(daily.select(DATE, "_total"), DATE).select(
        DATE, F.col("event_name").alias("parameter"), F.lit("Pipeline").alias("category"), (total + added).alias("value")
    )
    return fixed.unionByName(per_deal)


def _against_base(stats: DataFrame, column: str, out: str) -> DataFrame:
    base = stats.filter(F.col("category") == "Base").agg(F.max(column)).scalar()
    return stats.withColumn(out, base)


def sensitivity_shortfall(paths: DataFrame, ceiling, first: str, last: str) -> DataFrame:
    """Change of the period shortfall against the base, and its monthly cost."""
    stats = period_shortfall(paths, ceiling, first, last, ("parameter", "category"))
    delta = F.col("shortfall") - F.col("_base")
    return (
        _against_base(stats, "shortfall", "_base")
        .filter(F.col("category") != "Base")
        .select("parameter", "category", delta.alias("delta_shortfall"), monthly_cost(delta).alias("monthly_cost_impact"))
        .orderBy(F.abs("delta_shortfall"), "parameter")
    )


# Markers for a crossing that appears or vanishes under a variant.
PULLED_IN, PUSHED_OUT = -999, 999


def sensitivity_crossing(paths: DataFrame, ceiling, start: str) -> DataFrame:
    """Days by which each variant moves the crossing date.

    A deal or growth variant that crosses where the base does not is marked as pulled in; an
    efficiency variant that never crosses where the base does is marked as pushed out.
    """
    stats = ceiling_crossings(paths, ceiling, start, ("parameter", "category"))
    mine, base, gain = F.col("crossing_date"), F.col("_base"), F.col("category") == "Efficiency"
    moved = (
        F.when(mine.isNotNull() & base.isNotNull(), F.datediff(mine, base))
        .when(~gain & mine.isNotNull() & base.isNull(), F.lit(PULLED_IN))
        .when(gain & mine.isNull() & base.isNotNull(), F.lit(PUSHED_OUT))
        .otherwise(F.lit(0))
    )
    return (
        _against_base(stats, "crossing_date", "_base")
        .filter(F.col("category") != "Base")
        .select("parameter", "category", moved.alias("days_impact"))
        .orderBy(F.abs("days_impact"), "parameter")
    )


def first_day_drop(usage: DataFrame, forecast: DataFrame, start: str, target=TARGET) -> DataFrame:
    """First forecast day against the day before it, and the same transition a year earlier."""
    d0 = F.lit(start).cast("date")

    def on(day):
        return F.sum(F.when(F.col(DATE) == day, F.col(target)))

    actual = usage.filter(F.col(DATE).between(F.add_months(d0, -13), d0)).agg(
        on(F.date_sub(d0, 1)).alias("last_actual"),
        on(F.date_sub(F.add_months(d0, -12), 1)).alias("prev_year_last"),
        on(F.add_months(d0, -12)).alias("prev_year_first"),
    )
    first = forecast.filter(F.col(DATE) == d0).agg(F.sum("p50")).scalar()
    return actual.withColumn("first_forecast", first).withColumns(
        {
            "forecast_ratio": F.col("first_forecast") / F.col("last_actual"),
            "prev_year_ratio": F.col("prev_year_first") / F.col("prev_year_last"),
        }
    )
