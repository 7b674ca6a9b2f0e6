import datetime
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surgeline.operators import boosting, recursion
from surgeline.schema import DATE, KEYS, NUMERIC_FEATURES

START, DAYS = "1999-01-01", 12  # a holiday
DAY0 = datetime.date(1999, 1, 1)
USED = ["lag_1", "lag_7", "lag_28", "lag_365", "rolling_mean_7", "rolling_std_28", "is_holiday", "days_since_start", "series_level"]


def model(seed, names=("p10", "p50", "p90")):
    """Random small trees over a few features."""
    rng = random.Random(seed)
    rows = []
    for q in names:
        for t in range(3):
            inner = [(USED[rng.randrange(len(USED))], rng.choice([0.0, 0.5, 20.0, 95.0, 110.0])) for _ in range(3)]
            f = lambda i: boosting.MODEL_FEATURES.index(inner[i][0])
            rows.append((q, t, 0, f(0), inner[0][1], 1, 4, 0.0, 1.0))
            for node, i in ((1, 1), (4, 2)):
                rows.append((q, t, node, f(i), inner[i][1], node + 1, node + 2, 0.0, 1.0))
                rows += [(q, t, n, 0, np.inf, n, n, rng.uniform(-0.2, 0.2), 0.0) for n in (node + 1, node + 2)]
    return boosting.QuantileTrees(boosting.MODEL_FEATURES, {q: 0.01 * i for i, q in enumerate(names)}, pd.DataFrame(rows, columns=boosting.NODE_COLUMNS), {q: 3 for q in names})


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(2)
    usage = []
    for s, (ct, seg) in enumerate([("A", "x"), ("A", "y"), ("B", "x"), ("B", "y")]):
        for back in range(1, 420):
            # gaps; the last series has one row only
            if back == 3 if s == 3 else rng.random() > 0.1 * s:
                usage.append((DAY0 - datetime.timedelta(back), ct, seg, round(100 * rng.uniform(0.7, 1.4), 3)))
    usage += [(DAY0 + datetime.timedelta(d), "A", "x", 1e6) for d in range(DAYS)]  # what comes later is not known
    df = spark.createDataFrame(usage, "date date, compute_type string, customer_segment string, compute_hours double")
    keys = df.select(*KEYS).distinct()
    trends = keys.select(*KEYS, F.lit(4.5).alias("log_intercept"), F.lit(0.0005).alias("daily_growth_rate"), F.lit(0.0005).alias("uncapped_rate"), F.lit("1998-01-01").cast("date").alias("origin_date"))
    levels = keys.select(*KEYS, F.when(F.col("compute_type") == "A", 0.7).otherwise(0.2).alias("series_level"), F.lit(0.1).alias("type_level"), F.lit(0.2).alias("segment_level"))
    holidays = spark.createDataFrame([(DAY0, "New Year"), (DAY0 + datetime.timedelta(9), "Other")], "date date, holiday_name string")
    rows = keys.withColumn(DATE, F.explode(F.sequence(F.lit(START).cast("date"), F.date_add(F.lit(START).cast("date"), DAYS - 1))))
    horizon = recursion.static_features(rows, holidays, trends, levels, F.lit("1998-01-01").cast("date"))
    return df, horizon, usage, trends


def scored(trees, x):
    """One row through all trees of each quantile, node by node."""
    out = {}
    for q, base in trees.base.items():
        nodes = trees.nodes[trees.nodes["quantile"] == q]
        total = base
        for t in sorted(set(nodes["tree"])):
            tree = {r.node: r for r in nodes[nodes["tree"] == t].itertuples()}
            at = tree[0]
            while at.left != at.node:
                at = tree[at.left if x[trees.features[at.feature]] <= at.threshold else at.right]
            total += at.value
        out[q] = total
    return out


def plain(usage, horizon, trees):
    """One series and one day after the other, with dictionaries."""
    static = {(r.compute_type, r.customer_segment, r.date): r for r in horizon.collect()}
    out = {}
    for ct, seg in {k[:2] for k in static}:
        known = {d: v for d, c, s, v in usage if (c, s) == (ct, seg) and d < DAY0}
        for i in range(DAYS):
            day = DAY0 + datetime.timedelta(i)
            back = lambda k, day=day: known.get(day - datetime.timedelta(k))
            x = {c: float(static[ct, seg, day][c]) for c in ["series_level", "type_level", "segment_level", *[n for n in NUMERIC_FEATURES if not n.startswith(("lag_", "rolling_"))]]}
            for k in (1, 7, 14, 28, 365):
                x[f"lag_{k}"] = back(k)
            for w in (7, 28):
                seen = [back(k) for k in range(1, w + 1) if back(k) is not None]
                mean = sum(seen) / len(seen) if seen else None
                x[f"rolling_mean_{w}"] = mean
                x[f"rolling_std_{w}"] = math.sqrt(sum((v - mean) ** 2 for v in seen) / (len(seen) - 1)) if len(seen) > 1 else None
            x = {n: boosting.MISSING if v is None else v for n, v in x.items()}
            found = {q: max(static[ct, seg, day].trend * math.exp(v), 0.0) for q, v in scored(trees, x).items()}
            known[day] = found["p50"]
            out[ct, seg, day] = found
    return out


@pytest.mark.parametrize("series_per_task", [1, 2, 64])
def test_equals_a_plain_loop(frames, series_per_task):
    df, horizon, usage, _ = frames
    trees = model(5)
    got = recursion.recursive_forecast(df, horizon, trees, START, DAYS, series_per_task=series_per_task).collect()
    want = plain(usage, horizon, trees)
    assert len(got) == len(want) == 4 * DAYS
    for r in got:
        for q, v in want[r.compute_type, r.customer_segment, r.date].items():
            assert abs(r[q] - v) <= 1e-9 * max(1, abs(v))
    assert len({round(r.p50, 6) for r in got}) > DAYS  # the forecasts do feed on each other


def test_variants_in_one_job_equal_each_alone(frames):
    df, horizon, _, _ = frames
    caps = {0.05: model(5), 0.06: model(9)}
    both = horizon.withColumn("cap", F.explode(F.array(F.lit(0.05), F.lit(0.06)))).withColumn("trend", F.col("trend") * (1 + F.col("cap")))
    got = recursion.recursive_forecast(df, both, {str(c): m for c, m in caps.items()}, START, DAYS, series_per_task=2, variant="cap").collect()
    for cap, trees in caps.items():
        alone = recursion.recursive_forecast(df, both.filter(F.col("cap") == cap).drop("cap"), trees, START, DAYS).collect()
        key = lambda r: (r.compute_type, r.customer_segment, r.date)
        assert sorted((key(r), r.p50) for r in got if r.cap == cap) == sorted((key(r), r.p50) for r in alone)


def test_a_horizon_with_gaps_and_an_empty_one(frames):
    df, horizon, _, _ = frames
    some = horizon.filter(F.dayofmonth(DATE) % 3 == 1)
    got = recursion.recursive_forecast(df, some, model(5), START, DAYS).collect()
    assert {r.date.day for r in got} == {1, 4, 7, 10} and all(r.p50 is not None for r in got)
    assert recursion.recursive_forecast(df, horizon.limit(0), model(5), START, DAYS).collect() == []


def test_degradation_in_points(spark):
    rows = spark.createDataFrame([(d, "A", "x", 100.0) for d in range(2)] + [(5, "A", "x", 0.0)], "d int, compute_type string, customer_segment string, compute_hours double")
    rows = rows.withColumn(DATE, F.date_add(F.lit(START).cast("date"), F.col("d")))
    own = lambda v: rows.select(DATE, *KEYS, F.lit(v).alias("p50"))
    r = recursion.degradation(recursion.compared(own(112.0), own(110.0), rows)).first()
    assert abs(r.single_step_mape - 10) < 1e-9 and abs(r.recursive_mape - 12) < 1e-9 and abs(r.degradation_points - 2) < 1e-9 and r.n == 2


@pytest.mark.parametrize("cost, verdict", [(1.5, "similar"), (1.5001, "compounds"), (0.5, "similar"), (0.4999, "absorbed")])
def test_verdict_at_its_bounds(spark, cost, verdict):
    per_cap = spark.createDataFrame([(0.05, 11.0, 10.0 + cost), (0.06, 10.0, 10.0), (0.04, 50.0, 90.0)], "cap double, single_step_mape double, recursive_mape double")
    assert recursion.cap_verdict(per_cap, 0.05, 0.06).first().verdict == verdict
