"""Features, trends, calibration and scenarios on small frames."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeline.functions.quantiles import exact_quantile
from surgeline.operators import accuracy, conformal, events, explore, features, scenario, trend
from surgeline.schema import CALENDAR, KEYS, LAGS, require_columns

DAY = datetime.date(2023, 1, 1)
PANEL = "date date, compute_type string, customer_segment string, compute_hours double"


def series(spark, values, start=DAY, key=("A", "F")):
    return spark.createDataFrame([(start + datetime.timedelta(i), *key, float(v)) for i, v in enumerate(values)], PANEL)


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(42)
    return series(spark, [rng.uniform(1000, 5000) for _ in range(400)]).cache()


def test_lags_are_earlier_rows(sample):
    rows = features.with_history(sample, windows=[]).orderBy("date").collect()
    for k in LAGS:
        assert all(r[f"lag_{k}"] is None for r in rows[:k])
        assert all(rows[i][f"lag_{k}"] == rows[i - k].compute_hours for i in range(k, 400, 37))


def test_rolling_values_leave_out_the_row_itself(sample):
    rows = features.with_history(sample, lags=[]).orderBy("date").collect()
    y = [r.compute_hours for r in rows]
    assert rows[0].rolling_mean_7 is None and rows[1].rolling_std_7 is None
    for i in (1, 5, 7, 50, 399):
        back = y[max(0, i - 7) : i]
        assert math.isclose(rows[i].rolling_mean_7, np.mean(back))
        if len(back) > 1:
            assert math.isclose(rows[i].rolling_std_7, np.std(back, ddof=1))


def test_calendar_lags_see_gaps(spark, sample):
    holed = sample.filter(F.col("date") != F.lit("2023-01-10").cast("date"))
    row = features.with_history(holed, windows=[], exact_dates=True).filter("date = '2023-01-11'").first()
    assert row.lag_1 is None and row.lag_7 is not None


def test_calendar_of_known_dates(spark):
    days = spark.createDataFrame([(datetime.date(2023, 1, d), "A", "F", 1.0) for d in (2, 7, 8)], PANEL)
    got = {r.date.day: (r.day_of_week, r.is_weekend) for r in features.with_calendar(days).collect()}
    assert got == {2: (0, 0), 7: (5, 1), 8: (6, 1)}
    assert set(CALENDAR) <= set(features.with_calendar(days).columns)


def test_trend_is_found_and_capped(spark):
    slow = series(spark, [100 * math.exp(0.0005 * i) for i in range(300)])
    fast = series(spark, [100 * math.exp(0.01 * i) for i in range(300)], key=("B", "F"))
    got = {r.compute_type: r for r in trend.fit_trends(slow.unionByName(fast)).collect()}
    assert math.isclose(got["A"].daily_growth_rate, 0.0005, rel_tol=1e-6)
    assert math.isclose(got["B"].daily_growth_rate, math.log(1.06) / 30) and math.isclose(got["B"].uncapped_rate, 0.01, rel_tol=1e-6)


def test_one_row_and_nonpositive_series(spark):
    rows = series(spark, [7.0], key=("A", "one")).unionByName(series(spark, [0.0, -1.0, 5.0], key=("A", "odd")))
    got = {r.customer_segment: r for r in trend.fit_trends(rows).collect()}
    assert math.isclose(math.exp(got["one"].log_intercept), 7.0) and got["one"].daily_growth_rate == 0
    assert math.isclose(math.exp(got["odd"].log_intercept), 5.0)


def test_missing_trend_stops_the_job(spark, sample):
    other = series(spark, [1.0, 2.0], key=("Z", "Z"))
    with pytest.raises(Exception, match="no fitted trend"):
        trend.with_trend(other, trend.fit_trends(sample)).collect()


def test_ratio_round_trip_and_limits(spark, sample):
    rows = trend.residual_ratios(sample, trend.fit_trends(sample)).collect()
    assert all(math.isclose(r.trend * r.ratio, r.compute_hours, rel_tol=1e-9) for r in rows)
    low = trend.with_ratio(spark.createDataFrame([(0.2, 0.5), (1e9, 2.0)], "compute_hours double, trend double"))
    assert [r.ratio for r in low.collect()] == [0.2, 10.0]


def bands(spark, n, types=("A",), seed=42, width=300):
    rng = random.Random(seed)
    rows = []
    for t in types:
        for _ in range(n):
            y = rng.uniform(500, 5000)
            p50 = y + rng.gauss(0, 200)
            rows.append((t, y, p50 - width, p50, p50 + width))
    return spark.createDataFrame(rows, "compute_type string, compute_hours double, p10 double, p50 double, p90 double"), rows


def by_hand(rows):
    s = np.array([max(r[2] - r[1], r[1] - r[4]) / max(r[3], 1) for r in rows])
    return float(np.quantile(s, min(math.ceil((len(s) + 1) * 0.8) / len(s), 1.0)))


@pytest.mark.parametrize("n", [1, 2, 3, 100, 500])
def test_conformal_adjustment_is_the_finite_sample_quantile(spark, n):
    df, rows = bands(spark, n, ("A", "B"))
    got = {r.compute_type: r.adj for r in conformal.conformal_adjustments(df).collect()}
    for t in ("A", "B"):
        assert math.isclose(got[t], by_hand([r for r in rows if r[0] == t]), rel_tol=1e-9, abs_tol=1e-12)


def test_coverage_meets_its_target(spark):
    df, _ = bands(spark, 500, seed=123, width=50)
    out = conformal.apply_conformal(df, conformal.conformal_adjustments(df))
    assert out.agg(accuracy.coverage()).first()[0] >= 78


def test_unknown_type_keeps_its_band_and_served_ends_are_in_order(spark):
    df, _ = bands(spark, 20)
    other = df.withColumn("compute_type", F.lit("new"))
    assert sorted(conformal.apply_conformal(other, conformal.conformal_adjustments(df)).collect()) == sorted(other.collect())
    narrow = spark.createDataFrame([("A", -3.0)], "compute_type string, adj double")
    assert all(0 <= r.p10 <= r.p50 <= r.p90 for r in conformal.serve(df, narrow).collect())


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 30000])
@pytest.mark.parametrize("q", [0.0, 0.5, 0.81, 1.0])
def test_exact_quantile_of_any_size(spark, n, q):
    rng = random.Random(n)
    values = [float(rng.choice([rng.randrange(50), rng.random() * 50])) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], "g string, v double")
    row = exact_quantile(df, ["g"], "v", lambda _: F.lit(q), q, accuracy=200).first()
    assert math.isclose(row["quantile"], float(np.quantile(values, q)), rel_tol=1e-12, abs_tol=1e-12) and row.n == n


def test_zero_actuals_are_left_out_of_mape(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 11.0)], "compute_hours double, p50 double")
    assert math.isclose(df.agg(accuracy.mape()).first()[0], 10.0)


def test_a_fourth_type_is_not_dropped(spark):
    rows = None
    for t in "ARNX":
        one = series(spark, range(1, 60), key=(t, "F"))
        rows = one if rows is None else rows.unionByName(one)
    assert {r.compute_type for r in explore.monthly_mix(rows).collect()} == set("ARNX")
    assert explore.type_correlation(explore.totals(rows, "compute_type")).count() == 10


def deal_frame(spark, rows):
    return spark.createDataFrame(
        [(n, datetime.date(2023, 7, d), "A", s, h, p) for n, d, s, h, p in rows],
        "event_name string, expected_date date, compute_type string, customer_segment string, estimated_daily_hours double, probability double",
    )


def test_deals_with_one_prefix_and_without_a_series(spark):
    days = [(datetime.date(2023, 7, 1) + datetime.timedelta(i), "A", "F", 90.0, 100.0, 110.0) for i in range(60)]
    forecast = spark.createDataFrame(days, "date date, compute_type string, customer_segment string, p10 double, p50 double, p90 double")
    name = "a name of more than thirty-five characters, part "
    deals = deal_frame(spark, [(name + "one", 1, "F", 50.0, 0.5), (name + "two", 1, "F", 10.0, 0.5), ("elsewhere", 1, "Z", 99.0, 1.0)])
    paths = scenario.sensitivity_paths(forecast, deals, "A", "2023-09-01", "2023-07-01")
    got = {r.parameter: r.delta_shortfall for r in scenario.sensitivity_shortfall(paths, F.lit(100.0), "2023-07-01", "2023-08-29").collect()}
    assert math.isclose(got[name + "one"], 50) and math.isclose(got[name + "two"], 10) and got["elsewhere"] == 0
    high = scenario.high_scenario(forecast, deals).filter("date = '2023-07-05'").first()
    assert math.isclose(high.high_p50, 100 + 30 * 1.0) and math.isclose(high.high_p10, 90 + 30 * 0.7)


def test_ceiling_that_is_never_crossed(spark):
    long = spark.createDataFrame([(DAY, "base", "p50", 1.0)], "date date, scenario string, quantile string, value double")
    row = scenario.ceiling_crossings(long, F.lit(5.0), "2023-01-01").first()
    assert row.crossing_date is None and row.days_from_start is None and row.pct_days_over == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="compute_hours"):
        require_columns(spark.range(1), [*KEYS, "compute_hours"])


def test_first_rows_of_a_series(sample):
    assert explore.growth(explore.totals(sample)).count() == 1


def test_learned_rows_read_the_facts_once_and_equal_those_from_the_facts(spark, tmp_path, monkeypatch):
    """Features, holidays and origin come from the panel, whose size follows the calendar and not the facts."""
    from surgeline.plans import learned, views

    rng = random.Random(5)
    rows = [(datetime.datetime(1998, 11, 1) + datetime.timedelta(days=rng.randrange(500), hours=rng.randrange(24)), rng.choice("ANR"), rng.choice("FO"), float(rng.randrange(50))) for _ in range(600)]
    rows += [(None, "A", "F", 7.0), (datetime.datetime(1999, 1, 1, 23), None, "O", 3.0), (datetime.datetime(1999, 1, 2), "A", None, None)] * 2
    schema = "l_shipdate timestamp, l_returnflag string, l_linestatus string, l_quantity double"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    read, table = [], views.P.table
    monkeypatch.setattr(views.P, "table", lambda s, folder, name: read.append(name) or table(s, folder, name))
    monkeypatch.setattr(views, "_BUILT", {})
    folder = str(tmp_path)
    got = learned.feature_rows(spark, folder).collect()
    marked = views.panel_holidays(spark, folder).collect()
    assert read == ["lineitem"]
    want = views.until(views.feature_table(spark, folder, exact_dates=True), learned.S.TEST_END).collect()
    assert len(got) > 300 and sorted(got, key=str) == sorted(want, key=str)
    assert sorted(marked) == sorted(views.holidays(spark, folder).collect())
