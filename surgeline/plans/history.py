"""Lag, rolling, holiday and future-row features."""

from pyspark.sql import functions as F

from surgeline.operators import features
from surgeline.plans import settings as S
from surgeline.plans import views as V
from surgeline.plans.registry import query
from surgeline.schema import FEATURE_COLUMNS, LAG_COLUMNS, LONG_HORIZON_FEATURES, NEAR_TERM_FEATURES
from surgeline.sources import panel as P

ROLLING = "rolling_mean_7 rolling_std_7 rolling_mean_28 rolling_std_28"
KEYED = "date, compute_type, customer_segment"


@query("lag_features", oracle=V.sql("panel", f"SELECT {KEYED}, compute_hours, {V.LAG_SQL} FROM panel {V.WINDOW_W}"))
def lag_features(spark, folder):
    return features.with_history(V.usage(spark, folder), windows=[])


@query("rolling_features", ROLLING, oracle=V.sql("panel", f"SELECT {KEYED}, compute_hours, {V.ROLL_SQL} FROM panel"))
def rolling_features(spark, folder):
    return features.with_history(V.usage(spark, folder), lags=[])


@query("calendar_lag_features", oracle=V.sql("panel", f"SELECT {KEYED}, compute_hours, {V.CAL_LAG_SQL} FROM panel"))
def calendar_lag_features(spark, folder):
    return features.with_history(V.usage(spark, folder), windows=[], exact_dates=True)


@query("calendar_rolling_features", ROLLING, oracle=V.sql("panel", f"SELECT {KEYED}, compute_hours, {V.CAL_ROLL_SQL} FROM panel"))
def calendar_rolling_features(spark, folder):
    return features.with_history(V.usage(spark, folder), lags=[], exact_dates=True)


@query("holiday_features", oracle=V.sql("panel near", f"SELECT p.date, compute_type, customer_segment, {V.HOLIDAY_SQL} FROM panel p JOIN near n ON p.date = n.date"))
def holiday_features(spark, folder):
    return features.with_holidays(V.usage(spark, folder), V.holidays(spark, folder)).drop("compute_hours")


@query("trend_feature", oracle=V.sql("panel", f"SELECT {KEYED}, compute_hours, CAST(date - (SELECT MIN(date) FROM panel) AS INTEGER) AS days_since_start FROM panel"))
def trend_feature(spark, folder):
    return features.with_trend_feature(V.usage(spark, folder))


@query("build_features", ROLLING, oracle=V.sql("feat", f"SELECT date, {', '.join(FEATURE_COLUMNS)}, compute_hours FROM feat"))
def build_features(spark, folder):
    return V.feature_table(spark, folder)


def _future_sql(source, lags):
    lag_cols = "".join(
        f", (SELECT compute_hours FROM upto u WHERE u.compute_type = s.compute_type AND u.customer_segment = s.customer_segment AND u.date = s.date - {k}) AS lag_{k}"
        for k in lags
    )
    cal = V.CALENDAR_SQL
    return f""", cald AS (SELECT date, {cal} FROM (SELECT DISTINCT date FROM {source}) AS d),
 fnear AS (SELECT d.date, MIN(CASE WHEN h.date >= d.date THEN h.date - d.date END) AS nx, MIN(CASE WHEN h.date <= d.date THEN d.date - h.date END) AS la
 FROM (SELECT DISTINCT date FROM {source}) d, holidays h GROUP BY d.date)
 SELECT s.date, s.compute_type, s.customer_segment, s.compute_type || ' | ' || s.customer_segment AS series_id, c.* EXCLUDE (date), {V.HOLIDAY_SQL}{lag_cols},
 CAST(s.date - (SELECT MIN(date) FROM panel) AS INTEGER) AS days_since_start
 FROM {source} s JOIN cald c ON s.date = c.date JOIN fnear n ON s.date = n.date"""


def _future(needs, extra, source, lags):
    return V.sql(needs, extra + _future_sql(source, lags)).replace("\n, ", ",\n", 1)


_NEAR = f", near60 AS (SELECT * FROM scaf WHERE date <= DATE '{S.SIXTY_DAYS_TO}')"
_LONG = f", far AS (SELECT * FROM scaf WHERE date >= DATE '{S.LONG_RANGE_FROM}')"


def _horizon(spark, folder):
    known = V.until(V.usage(spark, folder), S.TEST_END)
    return known, P.scaffold(known, S.HORIZON_START, S.HORIZON_DAYS)


@query("near_term_features", oracle=_future("scaf holidays panel upto", _NEAR, "near60", [28, 365]))
def near_term_features(spark, folder):
    """Sixty days ahead: only lags that can be known, looked up by date."""
    known, rows = _horizon(spark, folder)
    rows = rows.filter(F.col("date") <= F.lit(S.SIXTY_DAYS_TO).cast("date"))
    out = features.horizon_features(known, rows, V.holidays(spark, folder), [28, 365], origin=V.origin(spark, folder))
    return out.select("date", *NEAR_TERM_FEATURES)


@query("long_horizon_features", oracle=_future("scaf holidays panel upto", _LONG, "far", []))
def long_horizon_features(spark, folder):
    """Months ahead: calendar, holidays, trend and categories only."""
    known, rows = _horizon(spark, folder)
    rows = rows.filter(F.col("date") >= F.lit(S.LONG_RANGE_FROM).cast("date"))
    out = features.horizon_features(known, rows, V.holidays(spark, folder), [], origin=V.origin(spark, folder))
    return out.select("date", *LONG_HORIZON_FEATURES)


_NEXT = ", nxt AS (SELECT DISTINCT (SELECT MAX(date) FROM upto) + 1 AS date, compute_type, customer_segment FROM upto)"
_NEXT_ROLL = "".join(
    f", (SELECT {fn}(compute_hours) FROM upto u WHERE u.compute_type = s.compute_type AND u.customer_segment = s.customer_segment AND u.date >= s.date - {w} AND u.date < s.date) AS rolling_{n}_{w}"
    for w in (7, 28) for fn, n in (("AVG", "mean"), ("STDDEV_SAMP", "std"))
)


@query(
    "next_day_features", ROLLING,
    oracle=_future("holidays panel upto", _NEXT, "nxt", [1, 7, 14, 28, 365]).replace(", CAST(s.date - (SELECT MIN(date) FROM panel) AS INTEGER)", f"{_NEXT_ROLL}, CAST(s.date - (SELECT MIN(date) FROM panel) AS INTEGER)").replace(",\n CAST(s.date - (SELECT MIN", f"{_NEXT_ROLL},\n CAST(s.date - (SELECT MIN"),
)
def next_day_features(spark, folder):
    known = V.until(V.usage(spark, folder), S.TEST_END)
    return features.next_day_features(known, V.holidays(spark, folder), origin=V.origin(spark, folder)).select(
        "date", *[c for c in FEATURE_COLUMNS if c not in LAG_COLUMNS], *LAG_COLUMNS
    )
