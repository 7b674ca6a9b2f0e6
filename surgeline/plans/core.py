"""Panels, sources, projections, set operations, scalar functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from surgeline.functions import exprs
from surgeline.operators import boosting, events, explore, features
from surgeline.plans import settings as S
from surgeline.plans import views as V
from surgeline.plans.registry import query
from surgeline.schema import FEATURE_COLUMNS, NUMERIC_FEATURES
from surgeline.session import new_path
from surgeline.sources import holidays as H
from surgeline.sources import panel as P
from surgeline.sources import runs, side_tables

KEYED = "date, compute_type, customer_segment"


@query("daily_usage", oracle=V.sql("panel", "SELECT * FROM panel"))
def daily_usage(spark, folder):
    return V.usage(spark, folder)


@query("wide_daily_usage", "compute_hours", 2, oracle=V.sql("wide", "SELECT * FROM wide"))
def wide_daily_usage(spark, folder):
    return P.from_orders(spark, folder)


@query(
    "short_daily_usage", "compute_hours", 4,
    oracle="SELECT CAST(ts AS DATE) AS date, event_type AS compute_type, SUM(value) AS compute_hours, COUNT(*) AS n FROM events GROUP BY 1, 2",
)
def short_daily_usage(spark, folder):
    return P.daily_events(spark, folder)


@query("roundtrip_csv", oracle=V.sql("panel", "SELECT * FROM panel"))
def roundtrip_csv(spark, folder):
    path = new_path(spark, "usage-csv")
    P.write_usage(V.usage(spark, folder), path, "csv")
    return P.read_usage_csv(spark, path)


@query("roundtrip_parquet", oracle=V.sql("panel", "SELECT * FROM panel WHERE date >= DATE '1997-01-01' AND date < DATE '1997-04-01'"))
def roundtrip_parquet(spark, folder):
    """The panel laid out by month and a quarter of it read again."""
    path = new_path(spark, "usage-parquet")
    P.write_usage(V.usage(spark, folder), path)
    return P.read_usage(spark, path, "1997-01-01", "1997-03-31")


_TIER_SQL = "CASE " + " ".join(
    "WHEN holiday_name IN (" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + f") THEN '{tier}'"
    for tier, names in (("major", H.MAJOR), ("moderate", H.MODERATE))
) + " ELSE 'minor' END"


@query("holiday_tiers", "mean_hours", 6, oracle=V.sql("holidays panel", f"""SELECT tier, COUNT(*) AS n_days, AVG(hours) AS mean_hours FROM (SELECT h.date, {_TIER_SQL} AS tier, SUM(compute_hours) AS hours
 FROM holidays h JOIN panel p ON p.date = h.date GROUP BY 1, 2) AS d GROUP BY 1"""))
def holiday_tiers(spark, folder):
    """Mean daily total on holidays by their tier."""
    days = H.with_tier(V.holidays(spark, folder)).join(V.usage(spark, folder), "date")
    return days.groupBy("date", "tier").agg(F.sum("compute_hours").alias("hours")).groupBy("tier").agg(F.count(F.lit(1)).alias("n_days"), F.avg("hours").alias("mean_hours"))


@query("read_holidays", oracle=V.sql("holidays", "SELECT * FROM holidays"))
def read_holidays(spark, folder):
    """The holiday calendar through a file with a declared schema."""
    path = new_path(spark, "holidays-csv")
    side_tables.write_side_table(V.holidays(spark, folder), path, "holidays")
    return side_tables.read_side_table(spark, path, "holidays").rows


@query("holiday_calendar", oracle=V.sql("holidays", "SELECT * FROM holidays"))
def holiday_calendar(spark, folder):
    return V.holidays(spark, folder)


_ROLLUP = """, flagged AS (SELECT *, (compute_hours - m) / s AS z, compute_hours / m AS ratio FROM (SELECT *,
 AVG(compute_hours) OVER w AS m, STDDEV_SAMP(compute_hours) OVER w AS s, COUNT(*) OVER w AS c FROM panel
 WINDOW w AS (PARTITION BY compute_type, customer_segment ORDER BY date ROWS BETWEEN 14 PRECEDING AND 13 FOLLOWING)) AS a
 WHERE c = 28 AND s > 0),
 marked AS (SELECT *, CASE WHEN z > 0 THEN 'spike' ELSE 'dip' END AS kind, FLOOR(10 * (ratio - 1)) AS mag FROM flagged WHERE ABS(z) > 2.5)
"""
_EVENTS = """SELECT date AS event_date, date + 1 AS event_end_date, CASE WHEN MIN(mag) < 0 THEN 'churn' ELSE kind END AS event_type,
 kind || ' on ' || CAST(date AS VARCHAR) AS event_name, string_agg(DISTINCT compute_type, '; ' ORDER BY compute_type) AS affected_compute_types,
 string_agg(DISTINCT customer_segment, '; ' ORDER BY customer_segment) AS affected_segments,
 string_agg(printf('%+dx', CAST(mag AS INTEGER)), '; ' ORDER BY compute_type, customer_segment) AS magnitude
 FROM marked GROUP BY date, kind"""


def _with_views(body):
    return V.sql("panel", _ROLLUP + body).replace("\n, flagged", ",\nflagged")


@query("event_log_rollup", oracle=_with_views(_EVENTS))
def event_log_rollup(spark, folder):
    """Outlier days of the panel as events: per-series rows rolled up to one row per event."""
    rows = explore.with_outliers(V.usage(spark, folder)).filter(F.col("is_outlier") == 1)
    kind = F.when(F.col("z") > 0, "spike").otherwise("dip")
    per_series = rows.select(
        F.col("date").alias("event_date"),
        F.date_add("date", 1).alias("event_end_date"),
        kind.alias("event_type"),
        F.concat(kind, F.lit(" on "), F.col("date").cast("string")).alias("event_name"),
        "compute_type", "customer_segment",
        F.floor(10 * (F.col("compute_hours") / F.col("ma") - 1)).cast("int").alias("magnitude"),
    )
    return events.event_log(per_series, "%+dx")


@query("read_event_log", oracle=_with_views(f"""SELECT event_date, event_end_date, event_type, event_name, TRIM(ct) AS compute_type, TRIM(seg) AS customer_segment, len(string_split(magnitude, '; ')) AS n_magnitudes
 FROM (SELECT *, UNNEST(string_split(affected_compute_types, ';')) AS ct FROM ({_EVENTS}) AS e) AS a, UNNEST(string_split(affected_segments, ';')) AS u(seg)"""))
def read_event_log(spark, folder):
    """The rolled-up events through a delimited file: lists become arrays and those rows."""
    path = new_path(spark, "events-csv")
    log = event_log_rollup(spark, folder).withColumn("description", F.lit("found in the panel"))
    side_tables.write_side_table(log, path, "event_log")
    rows = side_tables.read_side_table(spark, path, "event_log").rows
    rows = rows.withColumn("compute_type", F.explode("affected_compute_types")).withColumn("customer_segment", F.explode("affected_segments"))
    return rows.select(*events.EVENT, "compute_type", "customer_segment", F.size("magnitude").cast("long").alias("n_magnitudes"))


_FEATURE_LIST = ", ".join(
    c if c not in NUMERIC_FEATURES else f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS
)


@query(
    "feature_matrix", "rolling_mean_7 rolling_std_7 rolling_mean_28 rolling_std_28",
    oracle=V.sql("feat", f"SELECT date, {_FEATURE_LIST} FROM feat"),
)
def feature_matrix(spark, folder):
    return features.feature_matrix(V.feature_table(spark, folder))


_SPLIT = f"CASE WHEN date <= DATE '{S.TRAIN_END}' THEN 'train' WHEN date <= DATE '{S.VAL_END}' THEN 'val' WHEN date <= DATE '{S.TEST_END}' THEN 'test' ELSE 'later' END"


@query(
    "temporal_split_counts",
    oracle=V.sql("panel", f"SELECT {_SPLIT} AS split, COUNT(*) AS n_rows, MIN(date) AS first_date, MAX(date) AS last_date, SUM(compute_hours) AS total_hours FROM panel GROUP BY 1"),
)
def temporal_split_counts(spark, folder):
    d = F.col("date")
    split = (
        F.when(d <= F.lit(S.TRAIN_END).cast("date"), "train")
        .when(d <= F.lit(S.VAL_END).cast("date"), "val")
        .when(d <= F.lit(S.TEST_END).cast("date"), "test")
        .otherwise("later")
    )
    return V.usage(spark, folder).groupBy(split.alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.sum("compute_hours").alias("total_hours"),
    )


@query(
    "series_zoom",
    oracle=V.sql("panel", "SELECT * FROM panel WHERE compute_type = 'A' AND customer_segment = 'F' AND date BETWEEN DATE '1998-03-24' AND DATE '1998-04-25'"),
)
def series_zoom(spark, folder):
    return V.usage(spark, folder).filter(
        (F.col("compute_type") == "A") & (F.col("customer_segment") == "F")
        & F.col("date").between(F.lit("1998-03-24").cast("date"), F.lit("1998-04-25").cast("date"))
    )


@query(
    "encode_categoricals",
    oracle=V.sql("panel", f"""SELECT {KEYED}, CAST(DENSE_RANK() OVER (ORDER BY compute_type) - 1 AS DOUBLE) AS compute_type_code,
 CAST(DENSE_RANK() OVER (ORDER BY customer_segment) - 1 AS DOUBLE) AS customer_segment_code FROM panel"""),
)
def encode_categoricals(spark, folder):
    return features.encode_categoricals(V.usage(spark, folder)).drop("compute_hours")


@query(
    "quality_profile", "mean std",
    oracle=V.sql("panel", """SELECT COUNT(*) - COUNT(date) AS null_date, COUNT(*) - COUNT(compute_type) AS null_compute_type,
 COUNT(*) - COUNT(customer_segment) AS null_customer_segment, COUNT(*) - COUNT(compute_hours) AS null_compute_hours,
 COUNT(*) FILTER (compute_hours = 0) AS zero_rows, COUNT(*) FILTER (compute_hours < 0) AS negative_rows, COUNT(compute_hours) AS n,
 AVG(compute_hours) AS mean, STDDEV_SAMP(compute_hours) AS std, MIN(compute_hours) AS min, MAX(compute_hours) AS max FROM panel"""),
)
def quality_profile(spark, folder):
    return explore.quality_profile(V.usage(spark, folder))


@query("usage_quartiles", "value", 6, oracle=V.sql("panel", " UNION ALL ".join(f"SELECT '{n}' AS statistic, quantile_cont(compute_hours, {q}) AS value FROM panel" for n, q in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)))))
def usage_quartiles(spark, folder):
    """Quartiles of the target over all rows, exact at any size."""
    return explore.quartiles(V.usage(spark, folder))


@query(
    "usage_labels",
    oracle=V.sql("panel", """SELECT month, total, format('{:,}', CAST(round_even(total / 1000, 0) AS BIGINT)) || 'K' AS total_label, printf('%+.1f%%', (total / before - 1) * 100) AS change_label
 FROM (SELECT *, LAG(total) OVER (ORDER BY month) AS before FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, SUM(compute_hours) AS total FROM panel GROUP BY 1) AS m) AS b"""),
)
def usage_labels(spark, folder):
    """Monthly totals as report labels: thousands, and the change from the month before."""
    months = V.usage(spark, folder).groupBy(F.trunc("date", "MM").alias("month")).agg(F.sum("compute_hours").alias("total"))
    before = F.lag("total").over(Window.orderBy("month"))  # a row per month
    change = F.col("total") / before - 1
    return months.select("month", "total", exprs.kilo("total").alias("total_label"), F.when(change.isNotNull(), exprs.signed_percent(change * 100)).alias("change_label"))


@query(
    "feature_null_counts",
    oracle=V.sql("feat", " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT(*) - COUNT({c}) AS null_count FROM feat" for c in FEATURE_COLUMNS)),
)
def feature_null_counts(spark, folder):
    return explore.null_counts(V.feature_table(spark, folder), FEATURE_COLUMNS)


@query(
    "lag_check",
    oracle=V.sql("panel", """, r AS (SELECT *, ROW_NUMBER() OVER w AS rn, LAG(compute_hours, 7) OVER w AS l FROM panel WINDOW w AS (PARTITION BY compute_type, customer_segment ORDER BY date))
 SELECT a.compute_type, a.customer_segment, COUNT(*) AS n, COUNT(b.rn) AS n_with_lag, SUM(b.compute_hours) AS lag_7_sum,
 COUNT(*) FILTER (a.l IS DISTINCT FROM b.compute_hours) AS n_mismatch FROM r a LEFT JOIN r b ON a.compute_type = b.compute_type AND a.customer_segment = b.customer_segment
 AND b.rn = a.rn - 7 GROUP BY 1, 2""").replace("\n, r AS", ",\nr AS"),
)
def lag_check(spark, folder):
    """lag_7 against a self-join seven rows back."""
    w = Window.partitionBy("compute_type", "customer_segment").orderBy("date")
    numbered = features.with_history(V.usage(spark, folder), lags=[7], windows=[]).withColumn(
        "rn", F.row_number().over(w)
    )
    keys = ["compute_type", "customer_segment", "rn"]
    back = numbered.select(*keys[:2], (F.col("rn") + 7).alias("rn"), F.col("compute_hours").alias("seven_back"))
    return numbered.join(back, keys, "left").groupBy(*keys[:2]).agg(
        F.count(F.lit(1)).alias("n"), F.count("lag_7").alias("n_with_lag"), F.sum("lag_7").alias("lag_7_sum"),
        F.count_if(~F.col("lag_7").eqNullSafe(F.col("seven_back"))).alias("n_mismatch"),
    )


@query(
    "series_catalog",
    oracle=V.sql("panel", "SELECT compute_type, customer_segment, COUNT(*) AS n_days, MIN(date) AS first_date, MAX(date) AS last_date FROM panel GROUP BY 1, 2"),
)
def series_catalog(spark, folder):
    return P.series_catalog(V.usage(spark, folder)).orderBy("compute_type", "customer_segment")


@query(
    "usage_summary",
    oracle=V.sql("panel", """SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(date) AS first_date, MAX(date) AS last_date,
 COUNT(DISTINCT compute_type || '|' || customer_segment) AS n_series, COUNT(DISTINCT compute_type) AS n_types,
 COUNT(DISTINCT customer_segment) AS n_segments, SUM(compute_hours) AS total_hours, COUNT(DISTINCT date) AS n_days FROM panel"""),
)
def usage_summary(spark, folder):
    return explore.summary(V.usage(spark, folder))


@query("calendar_features", oracle=V.sql("panel", f"SELECT {KEYED}, {V.CALENDAR_SQL} FROM panel"))
def calendar_features(spark, folder):
    return features.with_calendar(V.usage(spark, folder)).drop("compute_hours")


@query(
    "date_labels",
    oracle=V.sql("panel", """SELECT DISTINCT date, dayname(date) AS day_name, strftime(date, '%b %Y') AS month_label,
 CAST(date_trunc('month', date) AS DATE) AS month_start, CAST(date_trunc('quarter', date) AS DATE) AS quarter_start, date - 7 AS week_before FROM panel"""),
)
def date_labels(spark, folder):
    return V.usage(spark, folder).select("date").distinct().select(
        "date",
        F.date_format("date", "EEEE").alias("day_name"),
        F.date_format("date", "MMM yyyy").alias("month_label"),
        F.trunc("date", "MM").alias("month_start"),
        F.trunc("date", "quarter").alias("quarter_start"),
        F.date_sub("date", 7).alias("week_before"),
    )


@query(
    "dow_dummies",
    oracle=V.sql("panel", "SELECT DISTINCT date, " + ", ".join(f"CAST(isodow(date) = {i + 1} AS INTEGER) AS dow_{i}" for i in range(6)) + " FROM panel"),
)
def dow_dummies(spark, folder):
    return V.usage(spark, folder).select("date").distinct().select("date", *exprs.weekday_dummies())


@query(
    "slugify",
    oracle="""SELECT o_orderpriority AS label, regexp_replace(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
 'conformal_adj_' || regexp_replace(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS metric_key, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def slugify(spark, folder):
    labels = P.table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    slug = exprs.slug("label")
    return labels.select("label", slug.alias("slug"), F.concat(F.lit("conformal_adj_"), slug).alias("metric_key"), "n")


@query(
    "event_series_explode",
    oracle=V.sql("logx bytype panel", """SELECT event_name, event_type, x.compute_type, x.customer_segment, COUNT(p.date) AS days_in_panel, SUM(p.compute_hours) AS hours
 FROM logx x LEFT JOIN panel p ON p.compute_type = x.compute_type AND p.customer_segment = x.customer_segment AND p.date BETWEEN event_date AND event_end_date
 GROUP BY 1, 2, 3, 4"""),
)
def event_series_explode(spark, folder):
    """Delimited event lists exploded to series and met with the panel on the event's dates."""
    rows = events.on_dates(events.explode_series(V.event_log(spark)), F.col("event_date"), F.col("event_end_date"))
    keys = ["date", "compute_type", "customer_segment"]
    met = rows.join(V.usage(spark, folder).withColumn("day", F.col("date")), keys, "left")
    return met.groupBy("event_name", "event_type", *keys[1:]).agg(
        F.count("day").alias("days_in_panel"), F.sum("compute_hours").alias("hours")
    )


@query(
    "forecast_scaffold",
    oracle=V.sql("scaf", "SELECT * FROM scaf"),
)
def forecast_scaffold(spark, folder):
    return P.scaffold(V.until(V.usage(spark, folder), S.TEST_END), S.HORIZON_START, S.HORIZON_DAYS)


@query("seeded_sample", oracle=V.sql("panel", f"SELECT * FROM panel ORDER BY md5('42|' || CAST(date AS VARCHAR) || '|' || compute_type || '|' || customer_segment), {KEYED} LIMIT 2000"))
def seeded_sample(spark, folder):
    return boosting.seeded_sample(V.usage(spark, folder), 2000)


_FOLD_METRICS = ["mape", "mae", "rmse", "bias_pct"]


def naive_metrics(spark, folder):
    """Seasonal-naive metrics per calendar year, one row per year (a stand-in for training runs)."""
    from surgeline.operators import accuracy

    rows = features.with_history(V.usage(spark, folder), lags=[7], windows=[]).filter(F.col("lag_7").isNotNull())
    fns = {"mape": accuracy.mape, "mae": accuracy.mae, "rmse": accuracy.rmse, "bias_pct": accuracy.bias}
    return rows.groupBy(F.concat(F.lit("run_"), F.year("date").cast("string")).alias("run")).agg(
        *[fns[m]("lag_7").alias(m) for m in _FOLD_METRICS], F.count(F.lit(1)).alias("n_rows")
    )


_NAIVE_SQL = """, naive AS (SELECT 'run_' || CAST(year(date) AS VARCHAR) AS run, AVG(ABS(l - y) / ABS(y)) * 100 AS mape, AVG(ABS(l - y)) AS mae,
 SQRT(AVG((l - y) * (l - y))) AS rmse, AVG((l - y) / y) * 100 AS bias_pct, COUNT(*) AS n_rows FROM (SELECT date, compute_hours AS y,
 LAG(compute_hours, 7) OVER (PARTITION BY compute_type, customer_segment ORDER BY date) AS l FROM panel) AS s WHERE l IS NOT NULL GROUP BY 1)
"""


@query(
    "run_metrics", "value",
    oracle=V.sql("panel", _NAIVE_SQL + " UNION ALL ".join(f"SELECT run AS run_id, '{m}' AS key, CAST({m} AS DOUBLE) AS value FROM naive" for m in [*_FOLD_METRICS, "n_rows"])).replace("\n, naive", ",\nnaive"),
)
def run_metrics(spark, folder):
    """Metrics of every run appended to a long table and read back."""
    path = new_path(spark, "runs")
    runs.append_runs(runs.metrics_long(naive_metrics(spark, folder), "run"), path)
    return runs.read_runs(spark, path)


@query(
    "champion_version",
    oracle=V.sql("panel", _NAIVE_SQL + """SELECT 'seasonal_naive' AS model_name, max_by(version, promoted_at) AS champion_version, MAX(promoted_at) AS promoted_at
 FROM (SELECT CAST(substr(run, 5) AS INTEGER) AS version, make_date(CAST(substr(run, 5) AS INTEGER), 12, 31) AS promoted_at FROM naive WHERE mape < 1000) AS v""").replace("\n, naive", ",\nnaive"),
)
def champion_version(spark, folder):
    """One version per run, promoted at the end of its year if its error is acceptable."""
    year = F.substring("run", 5, 4).cast("int")
    versions = naive_metrics(spark, folder).filter(F.col("mape") < 1000).select(
        F.lit("seasonal_naive").alias("model_name"), year.alias("version"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("promoted_at"),
    )
    return runs.champion(versions)
