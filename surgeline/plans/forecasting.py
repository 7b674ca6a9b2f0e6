"""Trends, residual profiles, accuracy, calibration, scenarios, folds and monitors."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from surgeline.operators import accuracy, backtest, conformal, features, monitor, profile, scenario, trend
from surgeline.plans import settings as S
from surgeline.plans import views as V
from surgeline.plans.registry import query
from surgeline.session import new_path, written
from surgeline.sources import panel as P
from surgeline.sources import runs

KEYED = "date, compute_type, customer_segment"
SERIES = "compute_type, customer_segment"
Q3 = "p10 p50 p90"

# --- trend and rebuild ---


@query("trend_params", "log_intercept daily_growth_rate uncapped_rate", 8, oracle=V.sql("tp", f"SELECT {SERIES}, log_intercept, daily_growth_rate, uncapped_rate, origin_date FROM tp"))
def trend_params(spark, folder):
    return V.trends(spark, folder)


@query("trend_params_growing", "log_intercept daily_growth_rate uncapped_rate", 8, oracle=V.sql("growing", f"SELECT {SERIES}, log_intercept, daily_growth_rate, uncapped_rate, origin_date FROM ({V.trend_sql('growing')}) AS t"))
def trend_params_growing(spark, folder):
    """A measure that grows faster than the cap, so that the cap binds for every series."""
    rows = V.panel(spark, folder)
    start = rows.agg(F.min("date")).scalar()
    grown = rows.withColumn("compute_hours", F.col("compute_hours") * F.exp(S.GROWTH_PER_DAY * F.datediff("date", start)))
    return trend.fit_trends(grown, origin=start)


@query("trend_values", "trend", oracle=V.sql("panel tp", f"SELECT p.date, p.compute_type, p.customer_segment, {V.TREND_VALUE} AS trend FROM panel p {V.JOIN_T.format(t='tp')}"))
def trend_values(spark, folder):
    return trend.with_trend(V.panel(spark, folder), V.trends(spark, folder)).select("date", "compute_type", "customer_segment", "trend")


_RATIO = f"LEAST(GREATEST(p.compute_hours / GREATEST({V.TREND_VALUE}, 1.0), 0.1), 10.0)"


@query("residual_ratios", "ratio", oracle=V.sql("train tp", f"SELECT p.date, p.compute_type, p.customer_segment, {_RATIO} AS ratio FROM train p {V.JOIN_T.format(t='tp')}"))
def residual_ratios(spark, folder):
    rows = V.until(V.panel(spark, folder), S.TRAIN_END)
    return trend.residual_ratios(rows, V.trends(spark, folder)).select("date", "compute_type", "customer_segment", "ratio")


@query("ratio_stats", "ratio_mean ratio_std ratio_min ratio_max target_mean target_std target_min target_max range_reduction", 5,
       oracle=V.sql("train tp", f"""SELECT AVG(r) AS ratio_mean, STDDEV_SAMP(r) AS ratio_std, MIN(r) AS ratio_min, MAX(r) AS ratio_max, AVG(y) AS target_mean,
 STDDEV_SAMP(y) AS target_std, MIN(y) AS target_min, MAX(y) AS target_max, (MAX(y) / MIN(y)) / (MAX(r) / MIN(r)) AS range_reduction
 FROM (SELECT p.compute_hours AS y, {_RATIO} AS r FROM train p {V.JOIN_T.format(t='tp')}) AS s"""))
def ratio_stats(spark, folder):
    """Spread of the residual ratio beside that of the target itself."""
    rows = trend.residual_ratios(V.until(V.panel(spark, folder), S.TRAIN_END), V.trends(spark, folder))
    named = {"ratio": "ratio", "target": "compute_hours"}
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    out = rows.agg(*[fn(c).alias(f"{n}_{s}") for n, c in named.items() for s, fn in stats.items()])
    return out.withColumn("range_reduction", (F.col("target_max") / F.col("target_min")) / (F.col("ratio_max") / F.col("ratio_min")))


@query("fitted_rates", "monthly_rate annual_rate", oracle=V.sql("tp", f"SELECT {SERIES}, EXP(30 * uncapped_rate) - 1 AS monthly_rate, EXP(365 * uncapped_rate) - 1 AS annual_rate FROM tp"))
def fitted_rates(spark, folder):
    return trend.growth_rates(V.trends(spark, folder))


@query("fastest_growth_top4", "annual_rate", oracle=V.sql("tp", f"SELECT {SERIES}, EXP(365 * uncapped_rate) - 1 AS annual_rate FROM tp ORDER BY annual_rate DESC, {SERIES} LIMIT 4"))
def fastest_growth_top4(spark, folder):
    rates = trend.growth_rates(V.trends(spark, folder)).drop("monthly_rate")
    return rates.orderBy(F.desc("annual_rate"), "compute_type", "customer_segment").limit(4)


@query("hybrid_predictions", "trend p10 p50 p90", oracle=V.sql("test", f"SELECT {KEYED}, compute_hours, trend, p10, p50, p90 FROM test"))
def hybrid_predictions(spark, folder):
    return V.test(spark, folder).select("date", "compute_type", "customer_segment", "compute_hours", "trend", "p10", "p50", "p90")


# --- accuracy ---

_ERR = "ABS({p} - compute_hours) / ABS(NULLIF(compute_hours, 0.0))"
_MAPE = "AVG({e}) * 100".format(e=_ERR.format(p="p50"))
_INSIDE = "AVG(CAST(compute_hours BETWEEN p10 AND p90 AS INTEGER)) * 100"


def _evaluate(rows, names):
    both = "CASE WHEN {p} IS NOT NULL AND compute_hours IS NOT NULL THEN {p} END"
    one = "SELECT '{m}' AS model, AVG(ABS(q - compute_hours)) AS mae, SQRT(AVG((q - compute_hours) * (q - compute_hours))) AS rmse, AVG(ABS(q - compute_hours) / ABS(NULLIF(compute_hours, 0.0))) * 100 AS mape, AVG((q - compute_hours) / NULLIF(compute_hours, 0.0)) * 100 AS bias_pct, COUNT(q) AS n FROM (SELECT compute_hours, {b} AS q FROM {r}) AS e"
    return " UNION ALL ".join(one.format(m=m, b=both.format(p=p), r=rows) for m, p in names.items())


_METRICS = "mae rmse mape bias_pct"


@query("accuracy_overall", _METRICS, 5, oracle=V.sql("test", _evaluate("test", {"profile": "p50", "trend": "trend"})))
def accuracy_overall(spark, folder):
    return accuracy.evaluate(V.test(spark, folder), {"profile": "p50", "trend": "trend"})


_DIMS = f"CAST(GROUPING(compute_type) * 2 + GROUPING(customer_segment) AS INTEGER) AS grouping_level"
_SETS = "GROUP BY GROUPING SETS ((compute_type, customer_segment), (compute_type), (customer_segment), ())"


@query("accuracy_by_dims", "mape", 5, oracle=V.sql("test", f"SELECT {SERIES}, {_DIMS}, {_MAPE} AS mape, COUNT(*) AS n FROM test {_SETS}"))
def accuracy_by_dims(spark, folder):
    return accuracy.by_dims(V.test(spark, folder), {"mape": accuracy.mape(), "n": F.count(F.lit(1))})


@query("coverage_report", "coverage", 5, oracle=V.sql("test", f"SELECT {SERIES}, {_DIMS}, {_INSIDE} AS coverage, COUNT(*) AS n FROM test {_SETS}"))
def coverage_report(spark, folder):
    return accuracy.by_dims(V.test(spark, folder), {"coverage": accuracy.coverage(), "n": F.count(F.lit(1))})


@query("miss_direction", "above_share below_share coverage", 5, oracle=V.sql("test", """SELECT compute_type, COUNT(*) AS n, COUNT(*) FILTER (compute_hours > p90) AS above_p90,
 COUNT(*) FILTER (compute_hours < p10) AS below_p10, COUNT(*) FILTER (compute_hours > p90) / COUNT(*) AS above_share,
 COUNT(*) FILTER (compute_hours < p10) / COUNT(*) AS below_share, 1 - COUNT(*) FILTER (compute_hours > p90 OR compute_hours < p10) / COUNT(*) AS coverage FROM test GROUP BY 1"""))
def miss_direction(spark, folder):
    return accuracy.miss_direction(V.test(spark, folder))


_PCT = "(compute_hours - p50) / NULLIF(compute_hours, 0.0) * 100"


@query("residual_summary", "value", 5, oracle=V.sql("test", f""", e AS (SELECT *, {_PCT} AS pct FROM test)
 SELECT 'overall' AS dimension, 'all' AS member, 'median' AS statistic, MEDIAN(pct) AS value FROM e
 UNION ALL SELECT 'compute_type', compute_type, 'mean', AVG(pct) FROM e GROUP BY compute_type
 UNION ALL SELECT 'compute_type', compute_type, 'std', STDDEV_SAMP(pct) FROM e GROUP BY compute_type
 UNION ALL SELECT 'day_of_week', dayname(date), 'mean', AVG(pct) FROM e GROUP BY dayname(date)""").replace("\n, e AS", ",\ne AS"))
def residual_summary(spark, folder):
    return accuracy.residual_summary(V.test(spark, folder))


def _buckets(edges, labels, closed, lowest):
    parts = []
    for lo, hi, name in zip(edges, edges[1:], labels):
        if closed == "right":
            first = f"d >= {lo}" if lowest and lo == edges[0] else f"d > {lo}"
            parts.append(f"WHEN {first} AND d <= {hi} THEN '{name}'")
        else:
            parts.append(f"WHEN d >= {lo} AND d < {hi} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


_FIRST = "(SELECT MIN(date) FROM test)"


@query("horizon_accuracy", "mape", 5, oracle=V.sql("test", ", h AS (SELECT *, date - " + _FIRST + " AS d FROM test) " + " UNION ALL ".join(
    f"SELECT '{r}' AS rule, {_buckets(*rule)} AS bucket, {_MAPE} AS mape, COUNT(*) AS n FROM h WHERE {_buckets(*rule)} IS NOT NULL GROUP BY 2"
    for r, *rule in accuracy.HORIZON_RULES)).replace("\n, h AS", ",\nh AS"))
def horizon_accuracy(spark, folder):
    """Error by distance from the first test day under the three bucket rules."""
    rows = V.test(spark, folder)
    return accuracy.horizon_accuracy(rows, rows.agg(F.min("date")).scalar())


@query("accuracy_aggregated", "mape_p50 mape_trend", 5, oracle=V.sql("test", """SELECT AVG(ABS(p - y) / ABS(y)) * 100 AS mape_p50, AVG(ABS(t - y) / ABS(y)) * 100 AS mape_trend, COUNT(*) AS n_days
 FROM (SELECT date, SUM(compute_hours) AS y, SUM(p50) AS p, SUM(trend) AS t FROM test GROUP BY date) AS d"""))
def accuracy_aggregated(spark, folder):
    return accuracy.aggregated_accuracy(V.test(spark, folder), ["p50", "trend"])


@query("pinball_loss", "pinball_p10 pinball_p50 pinball_p90", 5, oracle=V.sql("test", "SELECT " + ", ".join(
    f"AVG(GREATEST((compute_hours - {q}) * {a}, (compute_hours - {q}) * ({a} - 1))) AS pinball_{q}" for q, a in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))) + " FROM test"))
def pinball_loss(spark, folder):
    return accuracy.pinball_losses(V.test(spark, folder))


@query("worst_series_top5", "mape", 5, oracle=V.sql("test", f"SELECT {SERIES}, {_MAPE} AS mape FROM test GROUP BY {SERIES} ORDER BY mape DESC, {SERIES} LIMIT 5"))
def worst_series_top5(spark, folder):
    rows = V.test(spark, folder).groupBy("compute_type", "customer_segment").agg(accuracy.mape().alias("mape"))
    return rows.orderBy(F.desc("mape"), "compute_type", "customer_segment").limit(5)


# --- conformal calibration ---


@query("conformal_adj", "adj", 8, oracle=V.sql("conf", "SELECT compute_type, adj, n FROM conf"))
def conformal_adj(spark, folder):
    return V.adjustments(spark, folder)


@query("conformal_apply", Q3, oracle=V.sql("cal", f"SELECT {KEYED}, p10, p50, p90 FROM cal"))
def conformal_apply(spark, folder):
    return V.calibrated(spark, folder).select("date", "compute_type", "customer_segment", "p10", "p50", "p90")


@query("score_batch", Q3, oracle=V.sql("cal", f"SELECT {KEYED}, CASE WHEN p50 IS NOT NULL THEN LEAST(GREATEST(p10, 0.0), p50) END AS p10, p50, CASE WHEN p50 IS NOT NULL THEN GREATEST(p90, p50) END AS p90 FROM cal"))
def score_batch(spark, folder):
    """The served output: calibrated, not below zero, ends in order."""
    return conformal.serve(V.test(spark, folder), V.adjustments(spark, folder)).select("date", "compute_type", "customer_segment", "p10", "p50", "p90")


@query("calibrated_coverage", "coverage", 5, oracle=V.sql("cal", f"SELECT {SERIES}, {_DIMS}, {_INSIDE} AS coverage FROM cal {_SETS}"))
def calibrated_coverage(spark, folder):
    return accuracy.by_dims(V.calibrated(spark, folder), {"coverage": accuracy.coverage()})


@query("trend_params_json", "log_intercept daily_growth_rate", 8, oracle=V.sql("tp", f"SELECT {SERIES}, log_intercept, daily_growth_rate, origin_date FROM tp"))
def trend_params_json(spark, folder):
    """Trend parameters written as JSON payloads, one per series, and decoded again with a declared schema."""
    path = new_path(spark, "trend-json")
    runs.write_parts({"trends": V.fitted_profile(spark, folder)[0].drop("uncapped_rate")}, path)
    return runs.load_parts(spark, path, ["trends"])["trends"]


@query("load_components", Q3, oracle=V.sql("cal", f"SELECT {KEYED}, CASE WHEN p50 IS NOT NULL THEN LEAST(GREATEST(p10, 0.0), p50) END AS p10, p50, CASE WHEN p50 IS NOT NULL THEN GREATEST(p90, p50) END AS p90 FROM cal"))
def load_components(spark, folder):
    """Model parts stored, loaded again, and test rows served from what was loaded."""
    path = new_path(spark, "components")
    fits, shape = V.fitted_profile(spark, folder)
    runs.write_parts({"trends": fits.drop("uncapped_rate"), "profile": shape, "conformal": V.adjustments(spark, folder).drop("n")}, path)
    parts = runs.load_parts(spark, path, ["trends", "profile", "conformal"])
    rows = V.until(V.panel(spark, folder), S.TEST_END, S.VAL_END)
    scored = profile.predict_profile(rows, parts["trends"], parts["profile"])
    return conformal.serve(scored, parts["conformal"]).select("date", "compute_type", "customer_segment", "p10", "p50", "p90")


# --- baselines ---

_NAIVE_VIEWS = f""", hist AS (SELECT *, LAG(compute_hours, 1) OVER w AS lag_1, LAG(compute_hours, 7) OVER w AS lag_7,
 AVG(compute_hours) OVER (PARTITION BY {SERIES} ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS rolling_mean_28 FROM panel {V.WINDOW_W}),
 ends AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {SERIES} ORDER BY date) AS u, ROW_NUMBER() OVER (PARTITION BY {SERIES} ORDER BY date DESC) AS d FROM train),
 rate AS (SELECT {SERIES}, POW(AVG(compute_hours) FILTER (d <= 30) / AVG(compute_hours) FILTER (u <= 30), 1.0 / (MAX(date) - MIN(date))) - 1 AS daily_rate FROM ends GROUP BY {SERIES}),
 base AS (SELECT h.*, h.lag_7 * POW(1 + COALESCE(r.daily_rate, 0.0), 7) AS grown FROM hist h LEFT JOIN rate r ON h.compute_type = r.compute_type AND h.customer_segment = r.customer_segment
 WHERE h.date > DATE '{S.VAL_END}' AND h.date <= DATE '{S.TEST_END}')
"""
_BASELINES = {"yesterday": "lag_1", "last_week": "lag_7", "mean_28": "rolling_mean_28", "last_week_grown": "grown"}


def baselines(spark, folder):
    """Test rows with the four baseline predictions; a series without a growth rate keeps its level."""
    rows = features.with_history(V.panel(spark, folder), lags=[1, 7], windows=[28])
    rows = V.until(rows, S.TEST_END, S.VAL_END)
    rates = accuracy.edge_growth(V.until(V.panel(spark, folder), S.TRAIN_END))
    joined = rows.join(rates, ["compute_type", "customer_segment"], "left")
    return joined.withColumn("grown", F.col("lag_7") * F.pow(1 + F.coalesce("daily_rate", F.lit(0.0)), F.lit(7)))


@query("baseline_accuracy", _METRICS, 5, oracle=V.sql("panel train", _NAIVE_VIEWS + _evaluate("base", _BASELINES)).replace("\n, hist AS", ",\nhist AS"))
def baseline_accuracy(spark, folder):
    return accuracy.evaluate(baselines(spark, folder), _BASELINES)


@query("growth_adjusted_naive", "prediction", 5, oracle=V.sql("panel train", _NAIVE_VIEWS + f"SELECT {KEYED}, compute_hours, grown AS prediction FROM base").replace("\n, hist AS", ",\nhist AS"))
def growth_adjusted_naive(spark, folder):
    return baselines(spark, folder).select("date", "compute_type", "customer_segment", "compute_hours", F.col("grown").alias("prediction"))


@query("model_comparison", "mape_first mape_second delta", 4, oracle=V.sql("panel train test", _NAIVE_VIEWS + f"""SELECT *, CASE WHEN delta < -1 THEN 'better' WHEN delta > 1 THEN 'worse' ELSE 'same' END AS flag FROM (
 SELECT {SERIES}, a AS mape_first, b AS mape_second, b - a AS delta FROM (SELECT b.compute_type, b.customer_segment,
 AVG(ABS(b.lag_7 - b.compute_hours) / ABS(NULLIF(b.compute_hours, 0.0))) * 100 AS a, AVG(ABS(t.p50 - b.compute_hours) / ABS(NULLIF(b.compute_hours, 0.0))) * 100 AS b
 FROM base b JOIN test t ON b.date = t.date AND b.compute_type = t.compute_type AND b.customer_segment = t.customer_segment GROUP BY 1, 2) AS m) AS c""").replace("\n, hist AS", ",\nhist AS"))
def model_comparison(spark, folder):
    """Seasonal naive against the profile model, per series."""
    keys = ["date", "compute_type", "customer_segment"]
    rows = baselines(spark, folder).select(*keys, "compute_hours", "lag_7").join(V.test(spark, folder).select(*keys, "p50"), keys)
    return accuracy.compare_models(rows, "lag_7", "p50")


@query("model_comparison_overall", _METRICS, 5, oracle=V.sql("panel train test", _NAIVE_VIEWS + f""", duo AS (SELECT b.compute_hours, b.lag_7, t.p50 FROM base b JOIN test t ON b.date = t.date AND b.compute_type = t.compute_type AND b.customer_segment = t.customer_segment)
 """ + _evaluate("duo", {"last_week": "lag_7", "profile": "p50"})).replace("\n, hist AS", ",\nhist AS").replace("\n, duo AS", ",\nduo AS"))
def model_comparison_overall(spark, folder):
    """Both models over the same test rows."""
    keys = ["date", "compute_type", "customer_segment"]
    rows = baselines(spark, folder).select(*keys, "compute_hours", "lag_7").join(V.test(spark, folder).select(*keys, "p50"), keys)
    return accuracy.evaluate(rows, {"last_week": "lag_7", "profile": "p50"})


_RAW_IN, _CAL_IN = "AVG(CAST(t.compute_hours BETWEEN t.p10 AND t.p90 AS INTEGER)) * 100", "AVG(CAST(t.compute_hours BETWEEN c.p10 AND c.p90 AS INTEGER)) * 100"


@query("model_comparison_coverage", "coverage_first coverage_second delta", 4, oracle=V.sql("test cal", f"""SELECT compute_type, a AS coverage_first, b AS coverage_second, b - a AS delta, n FROM (SELECT COALESCE(t.compute_type, 'all types') AS compute_type, {_RAW_IN} AS a, {_CAL_IN} AS b, COUNT(*) AS n
 FROM test t JOIN cal c ON t.date = c.date AND t.compute_type = c.compute_type AND t.customer_segment = c.customer_segment GROUP BY ROLLUP (t.compute_type)) AS s"""))
def model_comparison_coverage(spark, folder):
    """Coverage of the raw and the calibrated interval, by type and over all types."""
    keys = ["date", "compute_type", "customer_segment"]
    second = V.calibrated(spark, folder).select(*keys, F.col("p10").alias("low"), F.col("p90").alias("high"))
    return accuracy.compare_coverage(V.test(spark, folder).join(second, keys), ("p10", "p90"), ("low", "high"))


@query("pred_vs_actual", "p50 error", 5, oracle=V.sql("fc panel", """SELECT f.date, f.compute_type, f.customer_segment, f.p50, p.compute_hours, f.p50 - p.compute_hours AS error
 FROM fc f LEFT JOIN panel p ON f.date = p.date AND f.compute_type = p.compute_type AND f.customer_segment = p.customer_segment"""))
def pred_vs_actual(spark, folder):
    """Every forecast row with its actual, if there is one yet."""
    keys = ["date", "compute_type", "customer_segment"]
    rows = V.forecast(spark, folder).select(*keys, "p50").join(V.panel(spark, folder), keys, "left")
    return rows.withColumn("error", F.col("p50") - F.col("compute_hours"))


# --- walk-forward folds and cap sweep ---


def fold_rows(spark, folder):
    """Panel rows once per fold they belong to: fold, role (fit, val, test) and the row."""
    return backtest.assign_folds(V.panel(spark, folder), S.FOLDS, S.FOLD_VAL_DAYS).drop("train_end", "test_end")


_FOLD_SQL = ", folds AS (" + S.values(S.FOLDS, ["fold", "train_end", "test_end"], ["train_end", "test_end"]) + f"""),
 fr AS (SELECT f.fold, p.*, CASE WHEN p.date <= f.train_end - {S.FOLD_VAL_DAYS} THEN 'fit' WHEN p.date <= f.train_end THEN 'val' ELSE 'test' END AS role FROM panel p JOIN folds f ON p.date <= f.test_end),
 ft AS (SELECT fold, {SERIES}, COALESCE(regr_intercept(LN(compute_hours), t), AVG(LN(compute_hours))) AS a, COALESCE(regr_slope(LN(compute_hours), t), 0.0) AS b, MIN(d0) AS d0
 FROM (SELECT *, CAST(date - d0 AS DOUBLE) AS t FROM (SELECT *, (SELECT MIN(date) FROM panel) AS d0 FROM fr) AS x) AS y WHERE role = 'fit' AND compute_hours > 0 GROUP BY fold, {SERIES}),
"""


@query("walk_forward_splits", oracle=V.sql("panel", _FOLD_SQL.rstrip().rstrip(",") + " SELECT fold, role, COUNT(*) AS n, MIN(date) AS first_date, MAX(date) AS last_date FROM fr GROUP BY 1, 2").replace("\n, folds AS", ",\nfolds AS").replace("folds AS", "folds AS", 1))
def walk_forward_splits(spark, folder):
    return fold_rows(spark, folder).groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def _fold_trends(spark, folder, caps):
    """Test rows of all folds with the trend under every cap; one fit per fold serves all caps."""
    rows = fold_rows(spark, folder)
    start = V.panel(spark, folder).agg(F.min("date")).scalar()
    keys = ["fold", "compute_type", "customer_segment"]
    fits = trend.fit_trends(rows.filter("role = 'fit'"), None, keys=keys, origin=start)
    listed = F.array(*[F.struct(F.lit(c).alias("cap"), F.lit(trend.daily_cap(c)).alias("_limit")) for c in caps])
    capped = fits.select("*", F.inline(listed)).withColumn("daily_growth_rate", F.least("uncapped_rate", "_limit")).drop("_limit")
    tested = rows.filter("role = 'test'").join(capped, keys)
    return tested.withColumn("p50", trend.trend_value()), fits


_CAP_ROWS = S.values([(c,) for c in S.CAPS], ["cap"])
_SWEEP = _FOLD_SQL + f""" caps AS ({_CAP_ROWS}), pr AS (SELECT r.fold, r.compute_type, r.customer_segment, c.cap, r.compute_hours, t.b > LN(1 + c.cap) / 30 AS binds,
 EXP(t.a + LEAST(t.b, LN(1 + c.cap) / 30) * (r.date - t.d0)) AS p50 FROM fr r JOIN ft t ON r.fold = t.fold AND r.compute_type = t.compute_type AND r.customer_segment = t.customer_segment, caps c WHERE r.role = 'test')
"""


def _folded(body):
    return V.sql("panel", _SWEEP + body).replace("\n, folds AS", ",\nfolds AS")


@query("trend_folds", "mape mae rmse", 4, oracle=_folded("SELECT fold, AVG(ABS(p50 - compute_hours) / ABS(NULLIF(compute_hours, 0.0))) * 100 AS mape, AVG(ABS(p50 - compute_hours)) AS mae, SQRT(AVG((p50 - compute_hours) * (p50 - compute_hours))) AS rmse, COUNT(*) AS n FROM pr WHERE cap = 0.06 GROUP BY 1"))
def trend_folds(spark, folder):
    """The folds scored by their capped trend alone."""
    rows, _ = _fold_trends(spark, folder, [trend.MAX_MONTHLY_GROWTH])
    return rows.groupBy("fold").agg(accuracy.mape().alias("mape"), accuracy.mae().alias("mae"), accuracy.rmse().alias("rmse"), F.count(F.lit(1)).alias("n"))


def _fold_views(folds):
    """The recipe within each fold as SQL: capped trend, weekday quantiles, calibration on the fold's tail, calibrated test rows ``fcal``."""
    value = "EXP(t.a + t.b * (r.date - t.d0))"
    on = "r.fold = t.fold AND r.compute_type = t.compute_type AND r.customer_segment = t.customer_segment"
    return ", folds AS (" + S.values(folds, ["fold", "train_end", "test_end"], ["train_end", "test_end"]) + f"""),
 fr AS (SELECT f.fold, f.train_end, f.test_end, p.*, CASE WHEN p.date <= f.train_end - {S.FOLD_VAL_DAYS} THEN 'fit' WHEN p.date <= f.train_end THEN 'val' ELSE 'test' END AS role FROM panel p JOIN folds f ON p.date <= f.test_end),
 ft AS (SELECT fold, {SERIES}, COALESCE(regr_intercept(LN(compute_hours), t), AVG(LN(compute_hours))) AS a, LEAST(COALESCE(regr_slope(LN(compute_hours), t), 0.0), {V.CAP}) AS b, MIN(d0) AS d0
 FROM (SELECT *, CAST(date - d0 AS DOUBLE) AS t FROM (SELECT *, (SELECT MIN(date) FROM panel) AS d0 FROM fr) AS x) AS y WHERE role = 'fit' AND compute_hours > 0 GROUP BY fold, {SERIES}),
 fp AS (SELECT fold, {SERIES}, dow, quantile_cont(lr, 0.1) AS q10, quantile_cont(lr, 0.5) AS q50, quantile_cont(lr, 0.9) AS q90 FROM (SELECT r.fold, r.compute_type, r.customer_segment, isodow(r.date) AS dow,
 LN(LEAST(GREATEST(r.compute_hours / GREATEST({value}, 1.0), 0.1), 10.0)) AS lr FROM fr r JOIN ft t ON {on} WHERE role = 'fit') AS s GROUP BY fold, {SERIES}, dow),
 fs AS (SELECT r.*, GREATEST({value} * EXP(q10), 0.0) AS p10, GREATEST({value} * EXP(q50), 0.0) AS p50, GREATEST({value} * EXP(q90), 0.0) AS p90 FROM fr r JOIN ft t ON {on}
 LEFT JOIN fp q ON q.fold = r.fold AND q.compute_type = r.compute_type AND q.customer_segment = r.customer_segment AND q.dow = isodow(r.date) WHERE role <> 'fit'),
 fsc AS (SELECT fold, compute_type, score, ROW_NUMBER() OVER (PARTITION BY fold, compute_type ORDER BY score) - 1 AS rn, COUNT(*) OVER (PARTITION BY fold, compute_type) AS n
 FROM (SELECT *, GREATEST(p10 - compute_hours, compute_hours - p90) / GREATEST(p50, 1.0) AS score FROM fs WHERE role = 'val' AND p50 IS NOT NULL) AS x),
 fh AS (SELECT *, LEAST(CEIL((n + 1) * CAST(0.8 AS DOUBLE)) / n, 1.0) * (n - 1) AS h FROM fsc),
 fa AS (SELECT fold, compute_type, MAX(CASE WHEN rn = FLOOR(h) THEN score END) + (MAX(CASE WHEN rn = LEAST(FLOOR(h) + 1, n - 1) THEN score END) - MAX(CASE WHEN rn = FLOOR(h) THEN score END)) * (MAX(h) - FLOOR(MAX(h))) AS adj
 FROM fh GROUP BY fold, compute_type),
 fcal AS (SELECT s.* REPLACE (s.p10 - COALESCE(a.adj, 0.0) * s.p50 AS p10, s.p90 + COALESCE(a.adj, 0.0) * s.p50 AS p90) FROM fs s LEFT JOIN fa a ON a.fold = s.fold AND a.compute_type = s.compute_type WHERE role = 'test')
"""


def _recipe(body, folds=S.FOLDS):
    return V.sql("panel", _fold_views(folds) + body).replace("\n, folds AS", ",\nfolds AS")


_SPLIT_METRICS = f"{_MAPE} AS mape_p50, AVG((p50 - compute_hours) / NULLIF(compute_hours, 0.0)) * 100 AS bias_pct, {_INSIDE} AS coverage_p10_p90, AVG(ABS(p50 - compute_hours)) AS mae, SQRT(AVG((p50 - compute_hours) * (p50 - compute_hours))) AS rmse, COUNT(*) AS n_test_rows"
_SPLIT_FLOATS = "mape_p50 bias_pct coverage_p10_p90 mae rmse"
_FOLD = ["fold", "train_end", "test_end"]


def _backtest(spark, folder, folds, label):
    """All folds fitted, calibrated and scored at once; written once per session."""
    def build():
        rows = written(backtest.assign_folds(V.panel(spark, folder), folds, S.FOLD_VAL_DAYS), "fold-rows")
        return backtest.fit_and_score(rows, ["fold"], origin=V.panel(spark, folder).agg(F.min("date")).scalar()).test

    return V.once(spark, folder, label, build)


@query("walk_forward_folds", _SPLIT_FLOATS, 4, oracle=_recipe(f"SELECT fold, train_end, test_end, {_SPLIT_METRICS} FROM fcal GROUP BY fold, train_end, test_end"))
def walk_forward_folds(spark, folder):
    """Each fold fitted on its past, calibrated on the last 90 days of it and scored on the half-year after."""
    return backtest.metrics(_backtest(spark, folder, S.FOLDS, "folds"), _FOLD)


@query("later_folds", _SPLIT_FLOATS, 4, oracle=_recipe(f"SELECT fold, train_end, test_end, {_SPLIT_METRICS} FROM fcal GROUP BY fold, train_end, test_end", S.LATER_FOLDS))
def later_folds(spark, folder):
    """The same over the second fold table; no fold looks at its test rows before they are scored."""
    return backtest.metrics(_backtest(spark, folder, S.LATER_FOLDS, "later-folds"), _FOLD)


@query("backtest_summary", "mean_mape std_mape min_mape max_mape range_mape", 4, oracle=_recipe(f"""SELECT compute_type, AVG(m) AS mean_mape, STDDEV_POP(m) AS std_mape, MIN(m) AS min_mape, MAX(m) AS max_mape, MAX(m) - MIN(m) AS range_mape FROM (
 SELECT fold, compute_type, {_MAPE} AS m FROM fcal GROUP BY 1, 2 UNION ALL SELECT fold, 'all types', {_MAPE} FROM fcal GROUP BY 1) AS s GROUP BY 1"""))
def backtest_summary(spark, folder):
    """Spread of the folds' error, per type and over all types."""
    test = _backtest(spark, folder, S.FOLDS, "folds")
    named = test.select("*", F.explode(F.array("compute_type", F.lit("all types"))).alias("member"))
    per_fold = named.groupBy("fold", F.col("member").alias("compute_type")).agg(accuracy.mape().alias("mape_p50"))
    return backtest.fold_summary(per_fold, ["compute_type"])


@query("fold_coverage", "adj coverage", 4, oracle=_recipe(f"SELECT c.fold, c.compute_type, MAX(adj) AS adj, {_INSIDE} AS coverage, COUNT(*) AS n FROM fcal c LEFT JOIN fa ON fa.fold = c.fold AND fa.compute_type = c.compute_type GROUP BY c.fold, c.compute_type"))
def fold_coverage(spark, folder):
    """Adjustment and coverage of every type in every fold."""
    rows = written(backtest.assign_folds(V.panel(spark, folder), S.FOLDS, S.FOLD_VAL_DAYS), "fold-rows")
    done = backtest.fit_and_score(rows, ["fold"], origin=V.panel(spark, folder).agg(F.min("date")).scalar())
    keys = ["fold", "compute_type"]
    inside = done.test.groupBy(*keys).agg(accuracy.coverage().alias("coverage"), F.count(F.lit(1)).alias("n"))
    return inside.join(done.adjustments.select(*keys, "adj"), keys, "left")


@query("model_comparison_folds", "mape_first mape_second delta", 4, oracle=V.sql("panel", _fold_views(S.FOLDS) + f""", two AS (SELECT c.fold, c.compute_hours, c.p50, EXP(t.a + t.b * (c.date - t.d0)) AS bare FROM fcal c JOIN ft t ON c.fold = t.fold AND c.compute_type = t.compute_type AND c.customer_segment = t.customer_segment)
 SELECT fold, a AS mape_first, b AS mape_second, b - a AS delta, CASE WHEN b - a < -1 THEN 'better' WHEN b - a > 1 THEN 'worse' ELSE 'same' END AS flag FROM (SELECT fold, {_ERR.format(p='bare').join(['AVG(', ') * 100'])} AS a, {_MAPE} AS b FROM two GROUP BY fold) AS s""").replace("\n, folds AS", ",\nfolds AS").replace("\n, two AS", ",\ntwo AS"))
def model_comparison_folds(spark, folder):
    """Folds side by side: the bare trend and the weekday profile on it."""
    return accuracy.compare_models(_backtest(spark, folder, S.FOLDS, "folds"), "trend", "p50", ["fold"])


@query("fit_and_evaluate", _SPLIT_FLOATS, 4, oracle=V.sql("cal", f"SELECT {_SPLIT_METRICS} FROM cal"))
def fit_and_evaluate(spark, folder):
    """One split from rows to metrics: fit on training rows, calibrate on validation rows, score test rows."""
    rows = written(backtest.assign_role(V.panel(spark, folder), S.TRAIN_END, S.VAL_END, S.TEST_END), "split-rows")
    return backtest.metrics(backtest.fit_and_score(rows, origin=V.panel(spark, folder).agg(F.min("date")).scalar()).test)


@query("cap_sweep", "mape", 4, oracle=_folded("SELECT cap, fold, AVG(ABS(p50 - compute_hours) / ABS(NULLIF(compute_hours, 0.0))) * 100 AS mape, COUNT(DISTINCT CASE WHEN binds THEN compute_type || '|' || customer_segment END) AS n_binding FROM pr GROUP BY 1, 2"))
def cap_sweep(spark, folder):
    """Error of the capped trend under every cap and fold, and the series a cap binds."""
    rows, _ = _fold_trends(spark, folder, S.CAPS)
    binds = F.col("uncapped_rate") > F.col("daily_growth_rate")
    per = rows.groupBy("cap", "fold", "compute_type", "customer_segment").agg(F.sum(accuracy.ape()).alias("e"), F.count(accuracy.ape()).alias("c"), F.max(binds).alias("b"))
    return per.groupBy("cap", "fold").agg((F.sum("e") / F.sum("c") * 100).alias("mape"), F.count_if("b").alias("n_binding"))


# --- scenarios ---


def _scenarios(spark, folder):
    return scenario.scenarios(V.forecast(spark, folder), V.deals(spark), S.EFFICIENCY_TYPE, S.EFFICIENCY_FROM)


def _daily(spark, folder):
    return V.once(spark, folder, "scenario-daily", lambda: scenario.scenario_daily(_scenarios(spark, folder)))


def _ceilings(spark, folder):
    return scenario.capacity_ceiling(V.panel(spark, folder), S.RECENT_FROM, S.TEST_END)


def _ceiling(spark, folder):
    return _ceilings(spark, folder).select("ceiling_mean").scalar()


_NINE = " ".join(f"{s}_{q}" for s in scenario.SCENARIOS for q in ("p10", "p50", "p90"))
_HIGH = "high_p10 high_p50 high_p90"
_LOW = "low_p10 low_p50 low_p90"


@query("scenario_high", _HIGH, oracle=V.sql("scen", f"SELECT {KEYED}, {_HIGH.replace(' ', ', ')} FROM scen"))
def scenario_high(spark, folder):
    return scenario.high_scenario(V.forecast(spark, folder), V.deals(spark)).select("date", "compute_type", "customer_segment", *_HIGH.split())


@query("scenario_low", _LOW, oracle=V.sql("scen", f"SELECT {KEYED}, {_LOW.replace(' ', ', ')} FROM scen"))
def scenario_low(spark, folder):
    return scenario.low_scenario(V.forecast(spark, folder), S.EFFICIENCY_TYPE, S.EFFICIENCY_FROM).select("date", "compute_type", "customer_segment", *_LOW.split())


@query("scenario_daily", _NINE, 5, oracle=V.sql("sday", f"SELECT date, {_NINE.replace(' ', ', ')} FROM sday"))
def scenario_daily(spark, folder):
    return _daily(spark, folder)


@query("scenario_long", "value", 5, oracle=V.sql("slong", "SELECT * FROM slong"))
def scenario_long(spark, folder):
    return scenario.scenario_long(_daily(spark, folder))


_SIX = [f"{s}_{q}" for s in scenario.SCENARIOS for q in ("p50", "p90")]


@query("monthly_scenarios", oracle=V.sql("sday", "SELECT CAST(date_trunc('month', date) AS DATE) AS month, " + ", ".join(f"round_even(AVG({c}), 0) AS {c}" for c in _SIX) + " FROM sday GROUP BY 1"))
def monthly_scenarios(spark, folder):
    return scenario.monthly_scenarios(_daily(spark, folder))


_ENVELOPE = [f"{q}_{s}" for q in ("p10", "p50", "p90") for s in ("avg", "min", "max")]


@query("monthly_envelope", " ".join(_ENVELOPE), 5, oracle=V.sql("sday", "SELECT strftime(date, '%b %Y') AS month_name, " + ", ".join(f"{s.upper()}(base_{q}) AS {q}_{s}" for q in ("p10", "p50", "p90") for s in ("avg", "min", "max")) + " FROM sday GROUP BY 1"))
def monthly_envelope(spark, folder):
    return scenario.monthly_envelope(V.forecast(spark, folder))


@query("forecast_60d", Q3, 5, oracle=V.sql("fc", f"SELECT compute_type, SUM(p10) AS p10, SUM(p50) AS p50, SUM(p90) AS p90, COUNT(DISTINCT date) AS n_days FROM fc WHERE date <= DATE '{S.SIXTY_DAYS_TO}' GROUP BY ROLLUP (compute_type)"))
def forecast_60d(spark, folder):
    """Totals of the first sixty days, by type and in all."""
    near = V.until(V.forecast(spark, folder), S.SIXTY_DAYS_TO)
    return near.rollup("compute_type").agg(*[F.sum(q).alias(q) for q in Q3.split()], F.countDistinct("date").alias("n_days"))


@query("forecast_union", "value", 5, oracle=V.sql("fc upto", f"SELECT date, 'actual' AS kind, SUM(compute_hours) AS value FROM upto WHERE date >= DATE '{S.RECENT_FROM}' GROUP BY date UNION ALL SELECT date, 'p50', SUM(p50) FROM fc GROUP BY date"))
def forecast_union(spark, folder):
    """Recent actual totals followed by the forecast's."""
    recent = V.until(V.panel(spark, folder), S.TEST_END).filter(F.col("date") >= F.lit(S.RECENT_FROM).cast("date"))
    actual = recent.groupBy("date").agg(F.sum("compute_hours").alias("value")).select("date", F.lit("actual").alias("kind"), "value")
    ahead = V.forecast(spark, folder).groupBy("date").agg(F.sum("p50").alias("value")).select("date", F.lit("p50").alias("kind"), "value")
    return actual.unionByName(ahead)


@query("capacity_ceiling", "recent_avg recent_peak ceiling_mean ceiling_peak", 5, oracle=V.sql("ceil", "SELECT * FROM ceil"))
def capacity_ceiling(spark, folder):
    return _ceilings(spark, folder)


_CEIL = "(SELECT ceiling_mean FROM ceil)"


@query("ceiling_crossings", "pct_days_over", 5, oracle=V.sql("slong ceil", f"""SELECT *, CAST(crossing_date - DATE '{S.HORIZON_START}' AS INTEGER) AS days_from_start FROM (SELECT scenario, quantile, MIN(date) FILTER (value >= {_CEIL}) AS crossing_date,
 COUNT(*) FILTER (value >= {_CEIL}) / COUNT(*) * 100 AS pct_days_over FROM slong GROUP BY 1, 2) AS c"""))
def ceiling_crossings(spark, folder):
    return scenario.ceiling_crossings(scenario.scenario_long(_daily(spark, folder)), _ceiling(spark, folder), S.HORIZON_START)


_SHORT = f"AVG(GREATEST(value - {_CEIL}, 0.0))"


@query("q4_shortfall", "shortfall monthly_cost", 5, oracle=V.sql("slong ceil", f"SELECT scenario, {_SHORT} AS shortfall, {_SHORT} * 30 * 2.5 AS monthly_cost FROM slong WHERE quantile = 'p90' AND date BETWEEN DATE '{S.Q4_FIRST}' AND DATE '{S.Q4_LAST}' GROUP BY 1"))
def q4_shortfall(spark, folder):
    long = scenario.scenario_long(_daily(spark, folder)).filter("quantile = 'p90'")
    return scenario.period_shortfall(long, _ceiling(spark, folder), S.Q4_FIRST, S.Q4_LAST)


@query("monthly_shortfall", "shortfall monthly_cost", 5, oracle=V.sql("slong ceil", f"SELECT scenario, CAST(date_trunc('month', date) AS DATE) AS month, {_SHORT} AS shortfall, {_SHORT} * 30 * 2.5 AS monthly_cost FROM slong WHERE quantile = 'p90' GROUP BY 1, 2"))
def monthly_shortfall(spark, folder):
    long = scenario.scenario_long(_daily(spark, folder)).filter("quantile = 'p90'")
    return scenario.monthly_shortfall(long, _ceiling(spark, folder))


_PATHS = f""", tot AS (SELECT date, SUM(p90) AS t, COALESCE(SUM(p90) FILTER (compute_type = '{S.EFFICIENCY_TYPE}' AND date >= DATE '{S.EFFICIENCY_FROM}'), 0.0) AS g,
 GREATEST(date - DATE '{S.HORIZON_START}', 0) AS o FROM fc GROUP BY date),
 paths AS (SELECT date, 'Base P90' AS parameter, 'Base' AS category, t AS value FROM tot
 UNION ALL SELECT date, 'Growth +10%', 'Growth', t * POW(CAST(1.1 AS DOUBLE), o / CAST(365 AS DOUBLE)) FROM tot UNION ALL SELECT date, 'Growth -10%', 'Growth', t * POW(CAST(0.9 AS DOUBLE), o / CAST(365 AS DOUBLE)) FROM tot
 UNION ALL SELECT date, 'Efficiency 10%', 'Efficiency', t - g * 0.1 FROM tot UNION ALL SELECT date, 'Efficiency 20%', 'Efficiency', t - g * 0.2 FROM tot
 UNION ALL SELECT t.date, d.event_name, 'Pipeline', t.t + CASE WHEN s.compute_type IS NOT NULL AND t.date >= d.expected_date THEN d.estimated_daily_hours ELSE 0.0 END
 FROM tot t, deals d LEFT JOIN (SELECT DISTINCT {SERIES} FROM fc) s ON s.compute_type = d.compute_type AND s.customer_segment = d.customer_segment)
"""


def _paths(spark, folder):
    return V.once(spark, folder, "sensitivity", lambda: scenario.sensitivity_paths(V.forecast(spark, folder), V.deals(spark), S.EFFICIENCY_TYPE, S.EFFICIENCY_FROM, S.HORIZON_START))


@query("sensitivity_shortfall", "delta_shortfall monthly_cost_impact", 5, oracle=V.sql("fc deals ceil", _PATHS + f""", st AS (SELECT parameter, category, {_SHORT} AS s FROM paths WHERE date BETWEEN DATE '{S.Q4_FIRST}' AND DATE '{S.Q4_LAST}' GROUP BY 1, 2)
 SELECT parameter, category, s - (SELECT s FROM st WHERE category = 'Base') AS delta_shortfall, (s - (SELECT s FROM st WHERE category = 'Base')) * 30 * 2.5 AS monthly_cost_impact FROM st WHERE category <> 'Base'""").replace("\n, tot AS", ",\ntot AS").replace("\n, st AS", ",\nst AS"))
def sensitivity_shortfall(spark, folder):
    return scenario.sensitivity_shortfall(_paths(spark, folder), _ceiling(spark, folder), S.Q4_FIRST, S.Q4_LAST)


@query("sensitivity_crossing", oracle=V.sql("fc deals ceil", _PATHS + f""", st AS (SELECT parameter, category, MIN(date) FILTER (value >= {_CEIL}) AS c FROM paths GROUP BY 1, 2),
 b AS (SELECT c AS b FROM st WHERE category = 'Base') SELECT parameter, category, CAST(CASE WHEN c IS NOT NULL AND b IS NOT NULL THEN c - b
 WHEN category <> 'Efficiency' AND c IS NOT NULL AND b IS NULL THEN -999 WHEN category = 'Efficiency' AND c IS NULL AND b IS NOT NULL THEN 999 ELSE 0 END AS INTEGER) AS days_impact FROM st, b WHERE category <> 'Base'""").replace("\n, tot AS", ",\ntot AS").replace("\n, st AS", ",\nst AS"))
def sensitivity_crossing(spark, folder):
    return scenario.sensitivity_crossing(_paths(spark, folder), _ceiling(spark, folder), S.HORIZON_START)


@query("first_day_drop", "last_actual prev_year_last prev_year_first first_forecast forecast_ratio prev_year_ratio", 5, oracle=V.sql("total fc", f"""SELECT *, first_forecast / last_actual AS forecast_ratio, prev_year_first / prev_year_last AS prev_year_ratio FROM (SELECT
 MAX(compute_hours) FILTER (date = DATE '{S.HORIZON_START}' - 1) AS last_actual, MAX(compute_hours) FILTER (date = CAST(DATE '{S.HORIZON_START}' - INTERVAL 1 YEAR AS DATE) - 1) AS prev_year_last,
 MAX(compute_hours) FILTER (date = CAST(DATE '{S.HORIZON_START}' - INTERVAL 1 YEAR AS DATE)) AS prev_year_first, (SELECT SUM(p50) FROM fc WHERE date = DATE '{S.HORIZON_START}') AS first_forecast FROM total) AS q"""))
def first_day_drop(spark, folder):
    return scenario.first_day_drop(V.panel(spark, folder), V.forecast(spark, folder), S.HORIZON_START)


# --- monitors ---

_ROLL = f"""SELECT compute_type, date, SUM(e) OVER w / SUM(c) OVER w * 100 AS rolling_mape FROM (SELECT compute_type, date, SUM({_ERR.format(p='p50')}) AS e, COUNT({_ERR.format(p='p50')}) AS c
 FROM test GROUP BY 1, 2) AS d WINDOW w AS (PARTITION BY compute_type ORDER BY date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW)"""


@query("monitor_rolling_mape", "rolling_mape", 5, oracle=V.sql("test", _ROLL))
def monitor_rolling_mape(spark, folder):
    return monitor.rolling_mape(V.test(spark, folder))


@query("monitor_breaches", "worst_mape", 4, oracle=V.sql("test", f"""SELECT compute_type, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS n_days, MAX(rolling_mape) AS worst_mape FROM (
 SELECT *, date - CAST(ROW_NUMBER() OVER (PARTITION BY compute_type ORDER BY date) AS INTEGER) AS island FROM ({_ROLL}) AS r WHERE rolling_mape > 15) AS i GROUP BY compute_type, island HAVING COUNT(*) >= 7"""))
def monitor_breaches(spark, folder):
    return monitor.breaches(monitor.rolling_mape(V.test(spark, folder)))


@query("monitor_weekly_coverage", "coverage_pct", 5, oracle=V.sql("test", f"SELECT *, CAST(coverage_pct < 70 AS INTEGER) AS needs_refresh FROM (SELECT compute_type, CAST(date_trunc('week', date) AS DATE) AS week, COUNT(compute_hours BETWEEN p10 AND p90) AS n, {_INSIDE} AS coverage_pct FROM test GROUP BY 1, 2) AS c"))
def monitor_weekly_coverage(spark, folder):
    return monitor.weekly_coverage(V.test(spark, folder))


@query("monitor_sign_runs", oracle=V.sql("test", f"""SELECT {SERIES}, sign, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS n_days FROM (
 SELECT *, SUM(new) OVER (PARTITION BY {SERIES} ORDER BY date) AS run FROM (SELECT *, CASE WHEN LAG(sign) OVER (PARTITION BY {SERIES} ORDER BY date) = sign THEN 0 ELSE 1 END AS new FROM (
 SELECT *, CAST(SIGN(compute_hours - p50) AS INTEGER) AS sign FROM test) AS a) AS b) AS c WHERE sign <> 0 GROUP BY {SERIES}, run, sign HAVING COUNT(*) >= 5"""))
def monitor_sign_runs(spark, folder):
    return monitor.sign_runs(V.test(spark, folder))


@query("retrain_windows", oracle=V.sql("panel", """, pm AS (SELECT CAST(date_trunc('month', date) AS DATE) AS m, COUNT(*) AS n FROM panel GROUP BY 1)
 SELECT a.m AS retrain_month, CAST(a.m - INTERVAL 24 MONTH AS DATE) AS window_start, a.m - 1 AS window_end, CAST(COALESCE(SUM(b.n), 0) AS BIGINT) AS n_rows, COUNT(b.n) AS n_months
 FROM pm a LEFT JOIN pm b ON b.m < a.m AND b.m >= a.m - INTERVAL 24 MONTH GROUP BY a.m""").replace("\n, pm AS", ",\npm AS"))
def retrain_windows(spark, folder):
    return monitor.retrain_windows(V.panel(spark, folder))


@query("seasonal_regression", "mape", 4, oracle=V.sql("total", f""", f AS (SELECT *, LN(compute_hours) AS l, CAST(date - (SELECT MIN(date) FROM total) AS DOUBLE) AS t FROM total WHERE compute_hours > 0),
 k AS (SELECT regr_intercept(l, t) AS a, regr_slope(l, t) AS b FROM f WHERE date <= DATE '{S.TRAIN_END}'), r AS (SELECT f.*, l - a - b * t AS e, a + b * t AS base FROM f, k),
 w AS (SELECT isodow(date) AS d, AVG(e) AS we FROM r WHERE date <= DATE '{S.TRAIN_END}' GROUP BY 1), m AS (SELECT month(date) AS d, AVG(e - we) AS me FROM r JOIN w ON isodow(date) = w.d WHERE date <= DATE '{S.TRAIN_END}' GROUP BY 1)
 SELECT AVG(ABS(EXP(base + we + me) - compute_hours) / compute_hours) * 100 AS mape, COUNT(*) AS n_days FROM r JOIN w ON isodow(date) = w.d JOIN m ON month(date) = m.d
 WHERE date > DATE '{S.VAL_END}' AND date <= DATE '{S.TEST_END}'""").replace("\n, f AS", ",\nf AS"))
def seasonal_regression(spark, folder):
    """Daily total: log-linear trend with weekday and month effects, scored on the test window."""
    daily = V.panel(spark, folder).groupBy("date").agg(F.sum("compute_hours").alias("compute_hours")).filter("compute_hours > 0")
    start = V.panel(spark, folder).agg(F.min("date")).scalar()
    rows = daily.select("date", "compute_hours", F.ln("compute_hours").alias("l"), F.datediff("date", start).cast("double").alias("t"), F.weekday("date").alias("dow"), F.month("date").alias("month"))
    rows = V.once(spark, folder, "daily-log", lambda: rows)
    train = V.until(rows, S.TRAIN_END)
    fit = train.agg(F.regr_intercept("l", "t").alias("a"), F.regr_slope("l", "t").alias("b")).first()
    rows = rows.withColumn("base", F.lit(fit["a"]) + F.lit(fit["b"]) * F.col("t")).withColumn("e", F.col("l") - F.col("base"))
    train = V.until(rows, S.TRAIN_END)
    week = train.groupBy("dow").agg(F.avg("e").alias("we"))
    year = train.join(F.broadcast(week), "dow").groupBy("month").agg(F.avg(F.col("e") - F.col("we")).alias("me"))
    tested = V.until(rows, S.TEST_END, S.VAL_END).join(F.broadcast(week), "dow").join(F.broadcast(year), "month")
    tested = tested.withColumn("p50", F.exp(F.col("base") + F.col("we") + F.col("me")))
    return tested.agg(accuracy.mape().alias("mape"), F.count(F.lit(1)).alias("n_days"))
