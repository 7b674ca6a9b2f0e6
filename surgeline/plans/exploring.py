"""Exploratory statistics."""

from pyspark.sql import functions as F

from surgeline.operators import events, explore
from surgeline.plans import settings as S
from surgeline.plans import views as V
from surgeline.plans.registry import query
from surgeline.sources import panel as P

SERIES = "compute_type, customer_segment"
CENTERED = "(PARTITION BY {by} ORDER BY date ROWS BETWEEN 14 PRECEDING AND 13 FOLLOWING)"


def _ma(source, by):
    w = CENTERED.format(by=by) if by else CENTERED.format(by="1").replace("PARTITION BY 1 ", "")
    return f"SELECT *, CASE WHEN ma <> 0 THEN compute_hours / ma END AS detrended FROM (SELECT *, CASE WHEN COUNT(*) OVER {w} = 28 THEN AVG(compute_hours) OVER {w} END AS ma FROM {source}) AS m"


@query("daily_total", oracle=V.sql("total", "SELECT * FROM total"))
def daily_total(spark, folder):
    return explore.totals(V.usage(spark, folder))


@query("daily_by_type", oracle=V.sql("bytype", "SELECT * FROM bytype"))
def daily_by_type(spark, folder):
    return explore.totals(V.usage(spark, folder), "compute_type")


@query("daily_by_segment", oracle=V.sql("panel", "SELECT date, customer_segment, SUM(compute_hours) AS compute_hours FROM panel GROUP BY 1, 2"))
def daily_by_segment(spark, folder):
    return explore.totals(V.usage(spark, folder), "customer_segment")


@query(
    "monthly_mix", "hours pct",
    oracle=V.sql("panel", """SELECT CAST(date_trunc('month', date) AS DATE) AS month, compute_type, SUM(compute_hours) AS hours,
 SUM(compute_hours) / SUM(SUM(compute_hours)) OVER (PARTITION BY date_trunc('month', date)) * 100 AS pct FROM panel GROUP BY date_trunc('month', date), compute_type"""),
)
def monthly_mix(spark, folder):
    return explore.monthly_mix(V.usage(spark, folder)).select("month", "compute_type", "hours", "pct")


@query("centered_ma28", "ma detrended", oracle=V.sql("panel", _ma("panel", SERIES)))
def centered_ma28(spark, folder):
    return explore.with_centered_mean(V.usage(spark, folder), ["compute_type", "customer_segment"])


_OUT = """SELECT *, CASE WHEN sd <> 0 THEN (compute_hours - ma) / sd END AS z FROM (SELECT *, CASE WHEN COUNT(*) OVER {w} = 28 THEN AVG(compute_hours) OVER {w} END AS ma,
 CASE WHEN COUNT(*) OVER {w} = 28 THEN STDDEV_SAMP(compute_hours) OVER {w} END AS sd FROM panel) AS m""".format(w=CENTERED.format(by=SERIES))


@query("outlier_flags", "ma sd z", oracle=V.sql("panel", f"SELECT *, CAST(COALESCE(ABS(z) > 2.5, FALSE) AS INTEGER) AS is_outlier FROM ({_OUT}) AS o"))
def outlier_flags(spark, folder):
    return explore.with_outliers(V.usage(spark, folder))


@query(
    "outlier_counts", "share",
    oracle=V.sql("panel", f"SELECT {SERIES}, CAST(GROUPING(compute_type) * 2 + GROUPING(customer_segment) AS INTEGER) AS grouping_level, COUNT(*) FILTER (COALESCE(ABS(z) > 2.5, FALSE)) AS outliers, COUNT(*) AS n, AVG(CASE WHEN ABS(z) > 2.5 THEN 1.0 ELSE 0.0 END) AS share FROM ({_OUT}) AS o GROUP BY GROUPING SETS (({SERIES}), ())"),
)
def outlier_counts(spark, folder):
    rows = explore.with_outliers(V.usage(spark, folder))
    ct, seg = F.col("compute_type"), F.col("customer_segment")
    return rows.groupingSets([[ct, seg], []], ct, seg).agg(
        F.grouping_id(ct, seg).cast("int").alias("grouping_level"),
        F.sum("is_outlier").alias("outliers"), F.count(F.lit(1)).alias("n"), F.avg("is_outlier").alias("share"),
    )


@query("month_profile", "level", oracle=V.sql("total", f"SELECT CAST(month(date) AS INTEGER) AS month, AVG(detrended) AS level FROM ({_ma('total', '')}) AS d GROUP BY 1"))
def month_profile(spark, folder):
    return explore.month_profile(explore.totals(V.usage(spark, folder)))


@query("volatility_cv", "cv", oracle=V.sql("panel", f"SELECT {SERIES}, STDDEV_SAMP(detrended) / AVG(detrended) AS cv FROM ({_ma('panel', SERIES)}) AS d GROUP BY 1, 2"))
def volatility_cv(spark, folder):
    return explore.volatility(V.usage(spark, folder))


@query(
    "type_correlation", "raw_corr detrended_corr", 5,
    oracle=V.sql("bytype", f""", d AS ({_ma('bytype', 'compute_type')}), k AS (SELECT COUNT(DISTINCT compute_type) AS k FROM bytype),
 full_days AS (SELECT date FROM d, k GROUP BY date, k HAVING COUNT(detrended) = k)
 SELECT a.compute_type AS type_a, b.compute_type AS type_b, CORR(a.compute_hours, b.compute_hours) AS raw_corr,
 CORR(CASE WHEN f.date IS NOT NULL THEN a.detrended END, CASE WHEN f.date IS NOT NULL THEN b.detrended END) AS detrended_corr
 FROM d a JOIN d b ON a.date = b.date AND a.compute_type <= b.compute_type LEFT JOIN full_days f ON f.date = a.date GROUP BY 1, 2""").replace("\n, d AS", ",\nd AS"),
)
def type_correlation(spark, folder):
    return explore.type_correlation(explore.totals(V.usage(spark, folder), "compute_type"))


@query(
    "usage_histogram", "bin_start density",
    oracle=V.sql("panel", f"""SELECT compute_type, customer_segment, bin, lo + bin * width AS bin_start, n,
 n / (SUM(n) OVER (PARTITION BY compute_type, customer_segment) * NULLIF(width, 0)) AS density FROM (
 SELECT p.compute_type, customer_segment, lo, width, CAST(COALESCE(LEAST(FLOOR((compute_hours - lo) / NULLIF(width, 0)), 49), 0) AS INTEGER) AS bin, COUNT(*) AS n
 FROM panel p JOIN (SELECT compute_type, MIN(compute_hours) AS lo, (MAX(compute_hours) - MIN(compute_hours)) / 50 AS width FROM panel GROUP BY 1) e
 ON p.compute_type = e.compute_type GROUP BY 1, 2, 3, 4, 5) AS h"""),
)
def usage_histogram(spark, folder):
    return explore.histogram(V.usage(spark, folder))


def _growth(source, by):
    cols = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT {cols}first_mean, last_mean, months, last_mean / first_mean AS multiple, POW(last_mean / first_mean, 1 / months) - 1 AS monthly_cagr,
 POW(POW(last_mean / first_mean, 1 / months), 12) - 1 AS annualized FROM (SELECT {cols}AVG(compute_hours) FILTER (u <= 30) AS first_mean,
 AVG(compute_hours) FILTER (d <= 30) AS last_mean, (MAX(date) - MIN(date)) / CAST(30.44 AS DOUBLE) AS months FROM (SELECT *,
 ROW_NUMBER() OVER ({part}ORDER BY date) AS u, ROW_NUMBER() OVER ({part}ORDER BY date DESC) AS d FROM {source}) AS r {'GROUP BY ' + by if by else ''}) AS g"""


GROWTH = "first_mean last_mean months multiple monthly_cagr annualized"


@query("growth_total", GROWTH, oracle=V.sql("total", _growth("total", "")))
def growth_total(spark, folder):
    return explore.growth(explore.totals(V.usage(spark, folder)))


@query(
    "growth_by_dim", GROWTH,
    oracle=V.sql("panel", f""", longd AS (SELECT 'compute_type' AS dimension, compute_type AS member, date, SUM(compute_hours) AS compute_hours FROM panel GROUP BY 1, 2, 3
 UNION ALL SELECT 'customer_segment', customer_segment, date, SUM(compute_hours) FROM panel GROUP BY 1, 2, 3)
 {_growth('longd', 'dimension, member')}""").replace("\n, longd", ",\nlongd"),
)
def growth_by_dim(spark, folder):
    """Both dimensions in one pass: each row counts once for its type and once for its segment."""
    members = F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).alias("member")) for c in ("compute_type", "customer_segment")
    ])
    long = V.usage(spark, folder).select("date", "compute_hours", F.inline(members))
    daily = long.groupBy("dimension", "member", "date").agg(F.sum("compute_hours").alias("compute_hours"))
    return explore.growth(daily, ["dimension", "member"])


@query(
    "growth_wide_panel", GROWTH, 5,
    oracle=V.sql("wide", _growth("wide", SERIES)),
)
def growth_wide_panel(spark, folder):
    return explore.growth(P.from_orders(spark, folder), ["compute_type", "customer_segment"])


@query(
    "dow_profile", "mean_hours relative",
    oracle=V.sql("panel", """SELECT p.compute_type, dayname(date) AS day_name, AVG(compute_hours) AS mean_hours, AVG(compute_hours) / MAX(m) AS relative
 FROM panel p JOIN (SELECT compute_type, AVG(compute_hours) AS m FROM panel GROUP BY 1) t ON p.compute_type = t.compute_type GROUP BY 1, 2"""),
)
def dow_profile(spark, folder):
    return explore.dow_profile(V.usage(spark, folder))


@query(
    "holiday_impact", "normal_weekday holiday impact_pct",
    oracle=V.sql("panel holidays", """SELECT customer_segment, AVG(compute_hours) FILTER (h IS NULL) AS normal_weekday, AVG(compute_hours) FILTER (h IS NOT NULL) AS holiday,
 (AVG(compute_hours) FILTER (h IS NOT NULL) / AVG(compute_hours) FILTER (h IS NULL) - 1) * 100 AS impact_pct
 FROM (SELECT p.*, d.date AS h FROM panel p LEFT JOIN (SELECT DISTINCT date FROM holidays) d ON p.date = d.date WHERE isodow(p.date) < 6) AS s GROUP BY 1"""),
)
def holiday_impact(spark, folder):
    return explore.holiday_impact(V.usage(spark, folder), V.holidays(spark, folder))


@query(
    "step_change_impact", "before_avg after_avg change_pct",
    oracle=V.sql("logx panel", """SELECT *, (after_avg - before_avg) / before_avg * 100 AS change_pct FROM (SELECT event_name, event_date, x.compute_type, x.customer_segment,
 AVG(compute_hours) FILTER (p.date < event_date) AS before_avg, AVG(compute_hours) FILTER (p.date >= event_date) AS after_avg
 FROM logx x LEFT JOIN panel p ON p.compute_type = x.compute_type AND p.customer_segment = x.customer_segment AND p.date >= event_date - 30 AND p.date < event_date + 30
 WHERE event_type = 'step_change' GROUP BY 1, 2, 3, 4) AS s"""),
)
def step_change_impact(spark, folder):
    return events.step_change_impact(V.usage(spark, folder), V.event_log(spark))


_OUTAGES = S.values(S.OUTAGES, ["event_name", "compute_type", "outage_start", "outage_end", "recovery_end"], ["outage_start", "outage_end", "recovery_end"])


@query(
    "outage_impact", "avg_hours share_of_normal",
    oracle=V.sql("bytype", f""", o AS ({_OUTAGES}), ph AS (SELECT event_name, b.compute_type, CASE WHEN date < outage_start THEN 'normal' WHEN date <= outage_end THEN 'outage' ELSE 'recovery' END AS phase,
 AVG(compute_hours) AS avg_hours FROM bytype b JOIN o ON b.compute_type = o.compute_type AND date >= outage_start - 14 AND date <= recovery_end GROUP BY 1, 2, 3)
 SELECT a.*, a.avg_hours / n.avg_hours AS share_of_normal FROM ph a JOIN ph n ON a.event_name = n.event_name AND a.compute_type = n.compute_type AND n.phase = 'normal'""").replace("\n, o AS", ",\no AS"),
)
def outage_impact(spark, folder):
    return events.outage_impact(
        explore.totals(V.usage(spark, folder), "compute_type"), S.frame(spark, S.OUTAGES, S.OUTAGE_SCHEMA)
    )


@query(
    "spike_windows",
    oracle=V.sql("logx panel", """SELECT event_name, p.date, p.compute_type, p.customer_segment, CAST(p.date - event_date AS INTEGER) AS day_offset, compute_hours
 FROM logx x JOIN panel p ON p.compute_type = x.compute_type AND p.customer_segment = x.customer_segment AND p.date BETWEEN event_date - 10 AND event_end_date + 10 WHERE event_type = 'spike'"""),
)
def spike_windows(spark, folder):
    return events.spike_windows(V.usage(spark, folder), V.event_log(spark))


def _acf(source, by, k, value="compute_hours"):
    cols = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {cols}n, CAST(lag AS INTEGER) AS lag, c / c0 AS acf FROM (SELECT {cols}COUNT(d) AS n, SUM(d * d) AS c0, {", ".join(f"SUM(d * l{i}) AS c{i}" for i in range(1, k + 1))} FROM (
 SELECT *, {", ".join(f"LAG(d, {i}) OVER ({part} ORDER BY date) AS l{i}" for i in range(1, k + 1))} FROM (SELECT {cols}date, {value} - AVG({value}) OVER ({part}) AS d FROM {source}) AS a) AS b
 {'GROUP BY ' + by if by else ''}) AS s, LATERAL (VALUES {", ".join(f"({i}, c{i})" for i in range(1, k + 1))}) AS u(lag, c)"""


@query("acf", "acf", 5, oracle=V.sql("panel", _acf("panel", SERIES, 35)))
def acf(spark, folder):
    return explore.autocorrelation(V.usage(spark, folder), 35, ["compute_type", "customer_segment"])


@query("acf_total", "acf", 5, oracle=V.sql("total", _acf("total", "", 35)))
def acf_total(spark, folder):
    return explore.autocorrelation(explore.totals(V.usage(spark, folder)), 35)


_PACF = f"""WITH RECURSIVE a AS ({_acf("p", SERIES, 35)}), rr AS (SELECT {SERIES}, list(acf ORDER BY lag) AS r FROM a GROUP BY {SERIES}),
 d AS (SELECT {SERIES}, r, 1 AS k, [r[1]] AS phi, r[1] AS pacf FROM rr UNION ALL
 SELECT {SERIES}, r, k + 1, list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - p * phi[k + 1 - j]), [p]), p FROM (
 SELECT *, (r[k + 1] - list_inner_product(phi, list_reverse(r[1:k]))) / (1 - list_inner_product(phi, r[1:k])) AS p FROM d WHERE k < 35) AS s)
 SELECT {SERIES}, CAST(k AS INTEGER) AS lag, pacf FROM d""".replace("WITH RECURSIVE a", f"WITH RECURSIVE p AS ({V.VIEWS['panel'][1]}), a")


@query("pacf", "pacf", 5, oracle=_PACF)
def pacf(spark, folder):
    keys = ["compute_type", "customer_segment"]
    return explore.partial_autocorrelation(explore.autocorrelation(V.usage(spark, folder), 35, keys), keys)


_RES = f", res AS (SELECT date, AVG(compute_hours - p50) AS r FROM test GROUP BY date), a AS ({_acf('res', '', 28, 'r')})"


@query(
    "ljung_box", "statistic", 4,
    oracle=V.sql("test", _RES + " UNION ALL ".join(f"SELECT MAX(n) AS n, {m} AS max_lag, MAX(n) * (MAX(n) + 2) * SUM(acf * acf / (n - lag)) AS statistic FROM a WHERE lag <= {m}" for m in (7, 14, 28))).replace("\n, res", ",\nres").replace("a AS (", "a AS (").replace(")SELECT MAX", ")\nSELECT MAX"),
)
def ljung_box(spark, folder):
    """Leftover autocorrelation of the mean daily residual on the test window."""
    rows = V.test(spark, folder)
    daily = rows.groupBy("date").agg(F.avg(F.col("compute_hours") - F.col("p50")).alias("r"))
    return explore.ljung_box(explore.autocorrelation(daily, 28, value="r"))


@query(
    "dickey_fuller", "slope t_stat", 4,
    oracle=V.sql("panel", f"""SELECT {SERIES}, n, slope, slope / SQRT((syy - slope * sxy) / (n - 2) / sxx) AS t_stat FROM (SELECT {SERIES}, COUNT(*) AS n, regr_slope(y - x, x) AS slope,
 regr_sxx(y - x, x) AS sxx, regr_syy(y - x, x) AS syy, regr_sxy(y - x, x) AS sxy FROM (SELECT *, compute_hours AS y, LAG(compute_hours) OVER (PARTITION BY {SERIES} ORDER BY date) AS x FROM panel) AS l
 WHERE x IS NOT NULL GROUP BY 1, 2) AS s"""),
)
def dickey_fuller(spark, folder):
    return explore.dickey_fuller(V.usage(spark, folder), ["compute_type", "customer_segment"])


_DEC = """, t AS (SELECT *, isodow(date) AS dow, CASE WHEN COUNT(*) OVER w = 7 THEN AVG(compute_hours) OVER w END AS trend FROM total WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
 e AS (SELECT dow, AVG(compute_hours - trend) AS raw FROM t GROUP BY 1),
 dec AS (SELECT date, compute_hours, trend, raw - (SELECT AVG(raw) FROM e) AS seasonal, compute_hours - trend - (raw - (SELECT AVG(raw) FROM e)) AS resid FROM t JOIN e ON t.dow = e.dow)
"""


@query("classical_decomposition", "trend seasonal resid", oracle=V.sql("total", _DEC + "SELECT * FROM dec").replace("\n, t AS", ",\nt AS"))
def classical_decomposition(spark, folder):
    return explore.classical_decomposition(explore.totals(V.usage(spark, folder)))


@query(
    "decomposition_shares", "trend_share seasonal_share resid_share",
    oracle=V.sql("total", _DEC + """SELECT VAR_SAMP(trend) / (VAR_SAMP(trend) + VAR_SAMP(seasonal) + VAR_SAMP(resid)) AS trend_share,
 VAR_SAMP(seasonal) / (VAR_SAMP(trend) + VAR_SAMP(seasonal) + VAR_SAMP(resid)) AS seasonal_share,
 VAR_SAMP(resid) / (VAR_SAMP(trend) + VAR_SAMP(seasonal) + VAR_SAMP(resid)) AS resid_share FROM dec""").replace("\n, t AS", ",\nt AS"),
)
def decomposition_shares(spark, folder):
    return explore.decomposition_shares(explore.classical_decomposition(explore.totals(V.usage(spark, folder))))
