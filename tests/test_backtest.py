import random

import pytest
from pyspark.sql import functions as F

from surgeline.functions.ranks import global_rank
from surgeline.operators import backtest, conformal, profile
from surgeline.sources import runs

USAGE = "date string, compute_type string, customer_segment string, compute_hours double"


@pytest.fixture(scope="module")
def usage(spark):
    import datetime

    rng = random.Random(3)
    day = datetime.date(1998, 1, 1)
    rows = []
    for i in range(730):
        for s, (ct, seg) in enumerate([("A", "x"), ("A", "y"), ("B", "x")]):
            if rng.random() > 0.05:
                rows.append((str(day + datetime.timedelta(i)), ct, seg, (100 + 40 * s) * (1 + 0.3 * (i % 7 == 6)) * rng.uniform(0.8, 1.25)))
    return spark.createDataFrame(rows, USAGE).withColumn("date", F.to_date("date")).cache()


FOLDS = [("one", "1999-03-31", "1999-05-31"), ("two", "1999-06-30", "1999-08-31")]


def test_folds_in_one_job_equal_each_fold_alone(usage):
    """The fold as a grouping key changes nothing: each fold equals the recipe on its own rows."""
    rows = backtest.assign_folds(usage, FOLDS, 60)
    origin = usage.agg(F.min("date")).scalar()
    together = {r.fold: r for r in backtest.metrics(backtest.fit_and_score(rows, ["fold"], origin=origin).test, ["fold"]).collect()}
    for name, _, _ in FOLDS:
        one = rows.filter(F.col("fold") == name).drop("fold")
        alone = backtest.metrics(backtest.fit_and_score(one, origin=origin).test).first()
        for c in ("mape_p50", "bias_pct", "coverage_p10_p90", "n_test_rows"):
            assert abs(together[name][c] - alone[c]) < 1e-9
        assert 60 < alone["coverage_p10_p90"] <= 100


def test_roles_do_not_overlap(usage):
    for r in backtest.assign_folds(usage, FOLDS, 60).groupBy("fold", "role").agg(F.min("date").alias("a"), F.max("date").alias("b")).collect():
        end = dict((n, e) for n, e, _ in FOLDS)[r.fold]
        assert {"fit": str(r.b) < end, "val": str(r.a) <= end and str(r.b) == end, "test": str(r.a) > end}[r.role]


def test_calibration_never_sees_the_test_rows(usage):
    rows = backtest.assign_folds(usage, FOLDS[:1], 60)
    other = rows.withColumn("compute_hours", F.when(F.col("role") == "test", F.col("compute_hours") * 9).otherwise(F.col("compute_hours")))
    origin = usage.agg(F.min("date")).scalar()
    a, b = (backtest.fit_and_score(r, ["fold"], origin=origin) for r in (rows, other))
    for part in ("trends", "profile", "adjustments"):
        assert sorted(map(str, getattr(a, part).collect())) == sorted(map(str, getattr(b, part).collect()))


def test_loaded_parts_score_alike(spark, usage, tmp_path):
    rows = backtest.assign_role(usage, "1999-06-30", "1999-09-30")
    done = backtest.fit_and_score(rows)
    parts = {"trends": done.trends.drop("uncapped_rate"), "profile": done.profile, "conformal": done.adjustments.drop("n")}
    runs.write_parts(parts, str(tmp_path / "parts"))
    loaded = runs.load_parts(spark, str(tmp_path / "parts"), list(parts))
    score = lambda p: sorted(conformal.serve(profile.predict_profile(usage, p["trends"], p["profile"]), p["conformal"]).collect())
    assert score(parts) == score(loaded)


def test_missing_and_broken_parts_fail_by_name(spark, usage, tmp_path):
    runs.write_parts({"conformal": spark.createDataFrame([("A", 0.1)], "compute_type string, adj double")}, str(tmp_path / "parts"))
    with pytest.raises(ValueError, match="trends"):
        runs.load_parts(spark, str(tmp_path / "parts"), ["conformal", "trends"])
    spark.createDataFrame([("trends", '{"log_intercept": "high"}')], "part string, payload string").write.partitionBy("part").parquet(str(tmp_path / "broken"))
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        runs.load_parts(spark, str(tmp_path / "broken"), ["trends"])["trends"].collect()


@pytest.mark.parametrize("per_bucket", [7, 1000])
def test_ranks_over_many_buckets(spark, per_bucket):
    df = spark.range(400).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"), "id").repartition(5)
    got = global_rank(df, "h", "id", by=["g"], per_bucket=per_bucket).collect()
    for g in range(3):
        own = sorted((r for r in got if r.g == g), key=lambda r: (r.h, r.id))
        assert [r["rank"] for r in own] == list(range(len(own)))
    assert global_rank(df.limit(0), "h").collect() == []
