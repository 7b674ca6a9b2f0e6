"""Feature table: calendar, holidays, lags, rolling statistics, trend."""

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.functions.exprs import calendar_columns, day_number, series_id
from surgeline.schema import DATE, FEATURE_COLUMNS, KEYS, LAGS, TARGET, WINDOWS

HOLIDAY_REACH = 30


def with_calendar(df: DataFrame, date=DATE) -> DataFrame:
    return df.withColumns(calendar_columns(date))


def holiday_proximity(holidays: DataFrame, reach: int = HOLIDAY_REACH) -> DataFrame:
    """Days to the next and from the last holiday for every date within ``reach`` of one.

    Distances are capped at ``reach`` anyway, so each holiday is spread over the dates it can
    matter to and the nearest wins: an equi-joinable table in place of an as-of join.
    """
    spread = holidays.select("date").distinct().select(
        F.col("date").alias("_h"),
        F.explode(F.sequence(F.date_sub("date", reach), F.date_add("date", reach))).alias(DATE),
    )
    ahead, behind = F.datediff("_h", DATE), F.datediff(DATE, "_h")
    return spread.groupBy(DATE).agg(
        F.min(F.when(ahead >= 0, ahead)).alias("_next"),
        F.min(F.when(behind >= 0, behind)).alias("_last"),
    )


def with_holidays(df: DataFrame, holidays: DataFrame, reach: int = HOLIDAY_REACH) -> DataFrame:
    near = holiday_proximity(holidays, reach)
    return (
        df.join(near, DATE, "left")
        .withColumns(
            {
                "is_holiday": F.coalesce((F.col("_next") == 0).cast("int"), F.lit(0)),
                "days_to_next_holiday": F.coalesce("_next", F.lit(reach)),
                "days_from_last_holiday": F.coalesce("_last", F.lit(reach)),
            }
        )
        .drop("_next", "_last")
    )


def _series(keys):
    return Window.partitionBy(*keys).orderBy(DATE)


def positional_lags(keys=KEYS, target=TARGET, lags=LAGS):
    """Value k rows back in the series, whatever its date."""
    return {f"lag_{k}": F.lag(target, k).over(_series(keys)) for k in lags}


def positional_rolling(keys=KEYS, target=TARGET, windows=WINDOWS):
    """Mean and sample deviation of the w rows before this one."""
    out = {}
    for w in windows:
        frame = _series(keys).rowsBetween(-w, -1)
        out[f"rolling_mean_{w}"] = F.avg(target).over(frame)
        out[f"rolling_std_{w}"] = F.stddev_samp(target).over(frame)
    return out


def calendar_lags(keys=KEYS, target=TARGET, lags=LAGS):
    """Value exactly k days back, NULL if that day is missing.

    A range frame of one day over the day number looks the value up without a join per lag.
    """
    by_day = Window.partitionBy(*keys).orderBy(day_number())
    return {f"lag_{k}": F.max(target).over(by_day.rangeBetween(-k, -k)) for k in lags}


def calendar_rolling(keys=KEYS, target=TARGET, windows=WINDOWS):
    """Mean and sample deviation of the values present in the w days before."""
    by_day = Window.partitionBy(*keys).orderBy(day_number())
    out = {}
    for w in windows:
        frame = by_day.rangeBetween(-w, -1)
        out[f"rolling_mean_{w}"] = F.avg(target).over(frame)
        out[f"rolling_std_{w}"] = F.stddev_samp(target).over(frame)
    return out


def with_history(df, keys=KEYS, target=TARGET, lags=LAGS, windows=WINDOWS, exact_dates=False):
    """All lag and rolling columns; every frame shares one exchange and one sort by series."""
    if exact_dates:
        cols = {**calendar_lags(keys, target, lags), **calendar_rolling(keys, target, windows)}
    else:
        cols = {**positional_lags(keys, target, lags), **positional_rolling(keys, target, windows)}
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def first_date(df: DataFrame):
    """Earliest date of the frame as a scalar Column (a subquery, not a join)."""
    return df.select(F.min(DATE)).scalar()


def with_trend_feature(df: DataFrame, origin=None, date=DATE) -> DataFrame:
    """Days since the origin; by default the earliest date of the whole frame."""
    start = first_date(df) if origin is None else origin
    start = F.lit(start).cast("date") if isinstance(start, str) else start
    return df.withColumn("days_since_start", F.datediff(date, start))


def build_features(
    usage: DataFrame,
    holidays: DataFrame,
    keys=KEYS,
    target=TARGET,
    lags=LAGS,
    windows=WINDOWS,
    origin=None,
    exact_dates=False,
) -> DataFrame:
    """The full feature table: 25 features, the date and the target.

    ``exact_dates`` switches lags and windows from row positions to calendar days, which is what
    a recursive or served forecast uses; the two agree where a series has no gap.
    """
    out = with_history(usage, keys, target, lags, windows, exact_dates)
    out = with_trend_feature(out, first_date(usage) if origin is None else origin)
    out = with_holidays(with_calendar(out), holidays)
    out = out.withColumn("series_id", series_id(keys))
    lag_cols = [f"lag_{k}" for k in lags]
    roll_cols = [f"rolling_{s}_{w}" for w in windows for s in ("mean", "std")]
    fixed = [c for c in FEATURE_COLUMNS if not c.startswith(("lag_", "rolling_"))]
    order = fixed[:-1] + lag_cols + roll_cols + fixed[-1:]
    return out.select(DATE, *[c for c in order if c not in keys or c in out.columns], target)


def feature_matrix(features: DataFrame, columns=FEATURE_COLUMNS) -> DataFrame:
    """Model input: id columns as strings, everything else as double."""
    types = dict(features.dtypes)
    cast = [F.col(c) if types[c] == "string" else F.col(c).cast("double") for c in columns]
    return features.select(DATE, *cast)


def encode_categoricals(df: DataFrame, columns=KEYS) -> DataFrame:
    """Category codes in alphabetical order, unseen values one past the last code."""
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_code" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    return indexer.fit(df).transform(df)


def next_day_features(usage: DataFrame, holidays: DataFrame, keys=KEYS, target=TARGET, origin=None):
    """Features of the day after the last observed date, for every series.

    One date needs no window: each lag and rolling value is a conditional aggregate over the last
    year, so partial aggregation does the work before the shuffle.
    """
    last = usage.select(F.max(DATE)).scalar()
    start = first_date(usage) if origin is None else origin
    back = F.datediff(last, DATE) + 1
    recent = usage.filter(back <= max(LAGS)).withColumn("_back", back)
    aggs = [F.max(F.when(F.col("_back") == k, F.col(target))).alias(f"lag_{k}") for k in LAGS]
    for w in WINDOWS:
        inside = F.when(F.col("_back") <= w, F.col(target))
        aggs += [
            F.avg(inside).alias(f"rolling_mean_{w}"),
            F.stddev_samp(inside).alias(f"rolling_std_{w}"),
        ]
    catalogue = usage.select(*keys).distinct()  # a series silent for a year still gets its row
    rows = catalogue.join(recent.groupBy(*keys).agg(*aggs), list(keys), "left").withColumn(DATE, F.date_add(last, 1))
    rows = with_holidays(with_calendar(with_trend_feature(rows, start)), holidays)
    return rows.withColumn("series_id", series_id(keys)).select(DATE, *FEATURE_COLUMNS)


def horizon_features(usage, horizon, holidays, lags, keys=KEYS, target=TARGET, origin=None):
    """Features of future rows: known lags by calendar date, calendar, holidays, trend.

    ``horizon`` holds dates and series without a target. History and horizon rows go through one
    range window per lag; only history rows carry a value, so nothing predicted leaks in.
    """
    start = first_date(usage) if origin is None else origin
    out = horizon
    if lags:
        both = usage.select(DATE, *keys, F.col(target).alias("_v"), F.lit(False).alias("_new")).unionByName(
            horizon.select(DATE, *keys, F.lit(None).cast("double").alias("_v"), F.lit(True).alias("_new"))
        )
        cols = calendar_lags(keys, "_v", lags)
        out = both.select("*", *[c.alias(n) for n, c in cols.items()]).filter("_new").drop("_v", "_new")
    out = with_holidays(with_calendar(with_trend_feature(out, start)), holidays)
    return out.withColumn("series_id", series_id(keys))
