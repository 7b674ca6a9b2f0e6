"""Shared SQL views of the checking queries, and the shared Spark frames of the queries."""

from pyspark.sql import functions as F

from surgeline.operators import conformal, features, profile, trend
from surgeline.plans import settings as S
from surgeline.session import written
from surgeline.sources import holidays as H
from surgeline.sources import panel as P

CAP = "(LN(CAST(1.06 AS DOUBLE)) / 30)"


def _nth(month, isodow, n):
    first = f"make_date(y, {month}, 1)"
    return f"({first} + CAST(({isodow} - isodow({first}) + 7) % 7 + {7 * (n - 1)} AS INTEGER))"


_LAST_MAY = "(make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) - 1) AS INTEGER))"
_HOLIDAYS = " UNION ALL ".join(
    f"SELECT CAST({d} AS DATE) AS date, '{n}' AS holiday_name FROM years"
    for d, n in [
        ("make_date(y, 1, 1)", "New Year''s Day"),
        (_nth(1, 1, 3), "MLK Day"),
        (_nth(2, 1, 3), "Presidents'' Day"),
        (_LAST_MAY, "Memorial Day"),
        ("make_date(y, 7, 4)", "Independence Day"),
        (_nth(9, 1, 1), "Labor Day"),
        (_nth(10, 1, 2), "Columbus Day"),
        ("make_date(y, 11, 11)", "Veterans Day"),
        (_nth(11, 4, 4), "Thanksgiving"),
        (f"({_nth(11, 4, 4)} + 1)", "Day After Thanksgiving"),
        ("make_date(y, 12, 25)", "Christmas Day"),
    ]
)

CALENDAR_SQL = """CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
 CAST(day(date) AS INTEGER) AS day_of_month, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
 CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(quarter(date) AS INTEGER) AS quarter,
 CAST(dayofyear(date) AS INTEGER) AS day_of_year,
 CAST(date - CAST(date_trunc('quarter', date) AS DATE) + 1 AS INTEGER) AS day_of_quarter,
 CAST(CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH AS DATE) - 1 - date <= 10 AS INTEGER) AS is_quarter_end"""

HOLIDAY_SQL = """COALESCE(CAST(nx = 0 AS INTEGER), 0) AS is_holiday,
 CAST(LEAST(COALESCE(nx, 30), 30) AS INTEGER) AS days_to_next_holiday,
 CAST(LEAST(COALESCE(la, 30), 30) AS INTEGER) AS days_from_last_holiday"""

LAG_SQL = ", ".join(f"LAG(compute_hours, {k}) OVER w AS lag_{k}" for k in (1, 7, 14, 28, 365))
ROLL_SQL = ", ".join(
    f"{fn}(compute_hours) OVER (PARTITION BY compute_type, customer_segment ORDER BY date "
    f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS rolling_{n}_{w}"
    for w in (7, 28) for fn, n in (("AVG", "mean"), ("STDDEV_SAMP", "std"))
)
_DAY_RANGE = (
    "(PARTITION BY compute_type, customer_segment ORDER BY date "
    "RANGE BETWEEN INTERVAL {a} DAY PRECEDING AND INTERVAL {b} DAY PRECEDING)"
)
CAL_LAG_SQL = ", ".join(
    f"MAX(compute_hours) OVER {_DAY_RANGE.format(a=k, b=k)} AS lag_{k}" for k in (1, 7, 14, 28, 365)
)
CAL_ROLL_SQL = ", ".join(
    f"{fn}(compute_hours) OVER {_DAY_RANGE.format(a=w, b=1)} AS rolling_{n}_{w}"
    for w in (7, 28) for fn, n in (("AVG", "mean"), ("STDDEV_SAMP", "std"))
)
WINDOW_W = "WINDOW w AS (PARTITION BY compute_type, customer_segment ORDER BY date)"


def trend_sql(source, cap=CAP):
    """Capped fits on a source with date, keys, compute_hours; origin is the source's first date."""
    return f"""SELECT compute_type, customer_segment, COALESCE(a, lv) AS log_intercept,
 LEAST(COALESCE(b, 0.0), {cap}) AS daily_growth_rate, COALESCE(b, 0.0) AS uncapped_rate, d0 AS origin_date FROM (
 SELECT compute_type, customer_segment, regr_intercept(LN(compute_hours), t) AS a, regr_slope(LN(compute_hours), t) AS b,
 AVG(LN(compute_hours)) AS lv, MIN(d0) AS d0 FROM (
 SELECT *, CAST(date - d0 AS DOUBLE) AS t FROM (SELECT *, MIN(date) OVER () AS d0 FROM {source}) AS s0) AS s1
 WHERE compute_hours > 0 GROUP BY 1, 2) AS s2"""


TREND_VALUE = "EXP(t.log_intercept + t.daily_growth_rate * (p.date - t.origin_date))"
JOIN_T = "JOIN {t} t ON p.compute_type = t.compute_type AND p.customer_segment = t.customer_segment"


def profile_sql(source, trends):
    return f"""SELECT compute_type, customer_segment, dow, quantile_cont(lr, 0.1) AS q10, quantile_cont(lr, 0.5) AS q50,
 quantile_cont(lr, 0.9) AS q90 FROM (SELECT p.compute_type, p.customer_segment, isodow(p.date) - 1 AS dow,
 LN(LEAST(GREATEST(p.compute_hours / GREATEST({TREND_VALUE}, 1.0), 0.1), 10.0)) AS lr
 FROM {source} p {JOIN_T.format(t=trends)}) AS s GROUP BY 1, 2, 3"""


def predict_sql(source, trends, prof, extra="p.compute_hours,"):
    return f"""SELECT p.date, p.compute_type, p.customer_segment, {extra} {TREND_VALUE} AS trend,
 GREATEST({TREND_VALUE} * EXP(f.q10), 0.0) AS p10, GREATEST({TREND_VALUE} * EXP(f.q50), 0.0) AS p50,
 GREATEST({TREND_VALUE} * EXP(f.q90), 0.0) AS p90 FROM {source} p {JOIN_T.format(t=trends)}
 LEFT JOIN {prof} f ON p.compute_type = f.compute_type AND p.customer_segment = f.customer_segment
 AND isodow(p.date) - 1 = f.dow"""


def conformal_sql(source):
    """Rank-interpolated quantile at the finite-sample level, per type."""
    return f"""SELECT compute_type, MAX(CASE WHEN rn = FLOOR(h) THEN score END) + (MAX(CASE WHEN rn = LEAST(FLOOR(h) + 1, n - 1)
 THEN score END) - MAX(CASE WHEN rn = FLOOR(h) THEN score END)) * (MAX(h) - FLOOR(MAX(h))) AS adj, MAX(n) AS n FROM (
 SELECT *, LEAST(CEIL((n + 1) * CAST(0.8 AS DOUBLE)) / n, 1.0) * (n - 1) AS h FROM (
 SELECT compute_type, GREATEST(p10 - compute_hours, compute_hours - p90) / GREATEST(p50, 1.0) AS score,
 ROW_NUMBER() OVER (PARTITION BY compute_type ORDER BY GREATEST(p10 - compute_hours, compute_hours - p90) / GREATEST(p50, 1.0)) - 1 AS rn,
 COUNT(*) OVER (PARTITION BY compute_type) AS n FROM {source} WHERE p50 IS NOT NULL) AS a) AS b GROUP BY compute_type"""


def calibrated_sql(source, adj):
    return f"""SELECT p.* REPLACE (p.p10 - COALESCE(c.adj, 0.0) * p.p50 AS p10, p.p90 + COALESCE(c.adj, 0.0) * p.p50 AS p90)
 FROM {source} p LEFT JOIN {adj} c ON p.compute_type = c.compute_type"""


VIEWS = {
    "panel": ("", """SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS compute_type, l_linestatus AS customer_segment,
 CAST(SUM(l_quantity) AS DOUBLE) AS compute_hours FROM lineitem GROUP BY 1, 2, 3"""),
    "growing": ("panel", f"""SELECT date, compute_type, customer_segment,
 compute_hours * EXP({S.GROWTH_PER_DAY} * (date - (SELECT MIN(date) FROM panel))) AS compute_hours FROM panel"""),
    "wide": ("", """SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS compute_type, c_mktsegment AS customer_segment,
 SUM(o_totalprice) AS compute_hours FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3"""),
    "years": ("panel", "SELECT UNNEST(range(year(MIN(date)), year(MAX(date)) + 2)) AS y FROM panel"),
    "holidays": ("years", _HOLIDAYS),
    "near": ("panel holidays", """SELECT d.date, MIN(CASE WHEN h.date >= d.date THEN h.date - d.date END) AS nx,
 MIN(CASE WHEN h.date <= d.date THEN d.date - h.date END) AS la
 FROM (SELECT DISTINCT date FROM panel) d, holidays h GROUP BY d.date"""),
    "feat": ("panel near", f"""SELECT f.date, compute_type, customer_segment, compute_type || ' | ' || customer_segment AS series_id,
 f.* EXCLUDE (date, compute_type, customer_segment, compute_hours), {HOLIDAY_SQL}, compute_hours
 FROM (SELECT *, {CALENDAR_SQL}, {LAG_SQL}, {ROLL_SQL}, CAST(date - (SELECT MIN(date) FROM panel) AS INTEGER) AS days_since_start
 FROM panel {WINDOW_W}) f LEFT JOIN near n ON f.date = n.date"""),
    "train": ("panel", f"SELECT * FROM panel WHERE date <= DATE '{S.TRAIN_END}'"),
    "upto": ("panel", f"SELECT * FROM panel WHERE date <= DATE '{S.TEST_END}'"),
    "tp": ("train", trend_sql("train")),
    "prof": ("train tp", profile_sql("train", "tp")),
    "hyb": ("panel tp prof", predict_sql("panel", "tp", "prof")),
    "val": ("hyb", f"SELECT * FROM hyb WHERE date > DATE '{S.TRAIN_END}' AND date <= DATE '{S.VAL_END}'"),
    "test": ("hyb", f"SELECT * FROM hyb WHERE date > DATE '{S.VAL_END}' AND date <= DATE '{S.TEST_END}'"),
    "conf": ("val", conformal_sql("val")),
    "cal": ("test conf", calibrated_sql("test", "conf")),
    "tpa": ("upto", trend_sql("upto")),
    "profa": ("upto tpa", profile_sql("upto", "tpa")),
    "scaf": ("upto", f"""SELECT CAST(UNNEST(generate_series(DATE '{S.HORIZON_START}', DATE '{S.HORIZON_START}' + {S.HORIZON_DAYS - 1},
 INTERVAL 1 DAY)) AS DATE) AS date, compute_type, customer_segment FROM (SELECT DISTINCT compute_type, customer_segment FROM upto) s"""),
    "fc": ("scaf tpa profa", predict_sql("scaf", "tpa", "profa", "")),
    "deals": ("", S.values(S.DEALS, ["event_name", "expected_date", "compute_type", "customer_segment",
                                      "estimated_daily_hours", "probability"], ["expected_date"])),
    "scen": ("fc deals", f"""SELECT f.date, f.compute_type, f.customer_segment, f.p10, f.p50, f.p90,
 f.p10 + 0.7 * COALESCE(SUM(estimated_daily_hours * probability), 0.0) AS high_p10,
 f.p50 + COALESCE(SUM(estimated_daily_hours * probability), 0.0) AS high_p50,
 f.p90 + 1.3 * COALESCE(SUM(estimated_daily_hours * probability), 0.0) AS high_p90,
 {", ".join(f"CASE WHEN f.compute_type = '{S.EFFICIENCY_TYPE}' AND f.date >= DATE '{S.EFFICIENCY_FROM}' THEN f.{q} * 0.85 ELSE f.{q} END AS low_{q}" for q in ("p10", "p50", "p90"))},
 f.p10 AS base_p10, f.p50 AS base_p50, f.p90 AS base_p90
 FROM fc f LEFT JOIN deals d ON f.compute_type = d.compute_type AND f.customer_segment = d.customer_segment AND f.date >= d.expected_date
 GROUP BY f.date, f.compute_type, f.customer_segment, f.p10, f.p50, f.p90"""),
    "sday": ("scen", "SELECT date, " + ", ".join(
        f"SUM({s}_{q}) AS {s}_{q}" for s in ("base", "high", "low") for q in ("p10", "p50", "p90")) + " FROM scen GROUP BY date"),
    "slong": ("sday", " UNION ALL ".join(
        f"SELECT date, '{s}' AS scenario, '{q}' AS quantile, {s}_{q} AS value FROM sday"
        for s in ("base", "high", "low") for q in ("p10", "p50", "p90"))),
    "ceil": ("upto", f"""SELECT AVG(t) AS recent_avg, MAX(t) AS recent_peak, round_even(AVG(t) * 1.25, -3) AS ceiling_mean,
 round_even(MAX(t) * 1.15, -3) AS ceiling_peak FROM (SELECT date, SUM(compute_hours) AS t FROM upto
 WHERE date >= DATE '{S.RECENT_FROM}' GROUP BY date) AS s"""),
    "total": ("panel", "SELECT date, SUM(compute_hours) AS compute_hours FROM panel GROUP BY date"),
    "bytype": ("panel", "SELECT date, compute_type, SUM(compute_hours) AS compute_hours FROM panel GROUP BY 1, 2"),
    "log": ("", S.values(S.EVENTS, ["event_date", "event_end_date", "event_type", "event_name", "affected_compute_types",
                                     "affected_segments"], ["event_date", "event_end_date"])),
    "logx": ("log", """SELECT event_date, event_end_date, event_type, event_name, TRIM(ct) AS compute_type, TRIM(seg) AS customer_segment
 FROM (SELECT *, UNNEST(string_split(affected_compute_types, ';')) AS ct FROM log) a, UNNEST(string_split(affected_segments, ';')) AS u(seg)"""),
}


def sql(needs, body):
    """A statement with the named views, and those they need, in front."""
    done = []

    def add(name):
        if name not in done:
            for n in VIEWS[name][0].split():
                add(n)
            done.append(name)

    for n in needs.split():
        add(n)
    views = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in done)
    return f"WITH {views}\n{body}" if views else body


# --- shared Spark frames ---------------------------------------------------------------------------


def usage(spark, folder):
    return P.from_lineitem(spark, folder)


def until(df, last, after=None):
    """Date filter with literal bounds, which reaches the scan below the daily sum."""
    cond = F.col("date") <= F.lit(last).cast("date")
    if after:
        cond = cond & (F.col("date") > F.lit(after).cast("date"))
    return df.filter(cond)


def origin(spark, folder):
    """First date of the facts: one column of the table, no daily sum."""
    return P.table(spark, folder, "lineitem").agg(F.to_date(F.min("l_shipdate"))).scalar()


def holidays(spark, folder):
    span = P.table(spark, folder, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b")
    )
    return H.holiday_calendar(span.select(F.explode(F.array("a", "b")).alias("date")))


def feature_table(spark, folder, exact_dates=False):
    return features.build_features(
        usage(spark, folder), holidays(spark, folder), origin=origin(spark, folder), exact_dates=exact_dates
    )


def panel(spark, folder):
    """The daily panel, written once per session: everything fitted or scored reads it, not the facts."""
    return once(spark, folder, "panel", lambda: usage(spark, folder))


def _panel_origin(spark, folder):
    return panel(spark, folder).agg(F.min("date")).scalar()


def panel_holidays(spark, folder):
    """The holidays of the panel's years; the same as ``holidays``, without another scan of the facts."""
    span = panel(spark, folder).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return H.holiday_calendar(span.select(F.explode(F.array("a", "b")).alias("date")))


def trends(spark, folder, last=S.TRAIN_END, cap=trend.MAX_MONTHLY_GROWTH, after=None):
    rows = until(panel(spark, folder), last, after)
    return trend.fit_trends(rows, cap, origin=_panel_origin(spark, folder))


def fitted_profile(spark, folder, last=S.TRAIN_END):
    """Trends and weekday profile of a training window, written once per session."""
    fits = once(spark, folder, f"trends-{last}", lambda: trends(spark, folder, last))
    rows = until(panel(spark, folder), last)
    prof = once(spark, folder, f"profile-{last}", lambda: profile.fit_profile(trend.residual_ratios(rows, fits)))
    return fits, prof


def hybrid(spark, folder, last=None, after=None):
    """Profile-model predictions of panel rows with parameters from the training window."""
    fits, prof = fitted_profile(spark, folder)
    rows = panel(spark, folder)
    return profile.predict_profile(until(rows, last, after) if last else rows, fits, prof)


def validation(spark, folder):
    return hybrid(spark, folder, S.VAL_END, S.TRAIN_END)


def test(spark, folder):
    return hybrid(spark, folder, S.TEST_END, S.VAL_END)


def adjustments(spark, folder):
    return conformal.conformal_adjustments(validation(spark, folder))


def calibrated(spark, folder):
    return conformal.apply_conformal(test(spark, folder), adjustments(spark, folder))


def forecast(spark, folder):
    """Profile-model forecast of the planning horizon with everything known by its start."""
    fits, prof = fitted_profile(spark, folder, S.TEST_END)
    rows = P.scaffold(until(panel(spark, folder), S.TEST_END), S.HORIZON_START, S.HORIZON_DAYS)
    return profile.predict_profile(rows, fits, prof).drop("trend")


def deals(spark):
    return S.frame(spark, S.DEALS, S.DEAL_SCHEMA)


def event_log(spark):
    return S.frame(spark, S.EVENTS, S.EVENT_SCHEMA)


_BUILT = {}


def once(spark, folder, label, build):
    """Write an expensive intermediate table once per session and read it from then on."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _BUILT:
        _BUILT[key] = written(build(), label)
    return _BUILT[key]
