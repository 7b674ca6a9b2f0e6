"""Learned quantile models, recursive forecasts, importance.

Trees depend on how Spark ML draws features and bins, so these queries have no SQL beside them; tests hold them
against plain loops. Lags and windows go by calendar days everywhere here, so that a
recursive forecast feeds the model what it was trained on.
"""

from pyspark.sql import functions as F

from surgeline.operators import accuracy, backtest, boosting, conformal, features, recursion, trend
from surgeline.plans import settings as S
from surgeline.plans import views as V
from surgeline.plans.registry import query
from surgeline.schema import DATE, FEATURE_COLUMNS, KEYS, QUANTILES, TARGET, feature_columns, require_columns
from surgeline.session import new_path, written
from surgeline.sources import panel as P
from surgeline.sources import runs

KEYED = [DATE, *KEYS]
NAMES = list(QUANTILES)
BOTH = ["hybrid", "level"]
FITTING = {"rounds": S.BOOST_ROUNDS, "rate": S.BOOST_RATE, "patience": S.BOOST_PATIENCE, "min_leaf": S.BOOST_MIN_LEAF}
_MODELS = {}


def labelled(rows, trends, by=()):
    """The rows twice, as variant ``hybrid`` (log of the residual ratio) and ``level`` (log of one plus the level)."""
    out = trend.with_ratio(trend.with_trend(rows, trends, [*by, *KEYS]))
    labels = {"hybrid": F.ln("ratio"), "level": F.log1p(F.col(TARGET))}
    listed = F.array(*[F.struct(F.lit(v).alias("variant"), c.alias("label")) for v, c in labels.items()])
    return out.select("*", F.inline(listed)).drop("ratio")


def encoded(rows, by):
    """Model input with category levels from the rows that are fitted on, for each group of ``by``."""
    levels = written(boosting.category_levels(rows.filter("role = 'fit'"), "label", by=by), "levels")
    return boosting.encode(rows, levels, by=by), levels


def feature_rows(spark, folder):
    """Features by calendar days of all panel rows up to the end of the test window, written once per session."""
    def build():
        holidays, start = V.panel_holidays(spark, folder), V._panel_origin(spark, folder)
        return V.until(features.build_features(V.panel(spark, folder), holidays, origin=start, exact_dates=True), S.TEST_END)

    return V.once(spark, folder, "feature-rows", build)


def split_rows(spark, folder):
    """Encoded rows of both variants on the main split, and the levels."""
    def build():
        rows = require_columns(backtest.assign_role(feature_rows(spark, folder), S.TRAIN_END, S.VAL_END), FEATURE_COLUMNS)
        return labelled(rows, V.fitted_profile(spark, folder)[0])

    rows = V.once(spark, folder, "split-labelled", build)
    levels = V.once(spark, folder, "split-levels", lambda: boosting.category_levels(rows.filter("role = 'fit'"), "label", by=["variant"]))
    return V.once(spark, folder, "split-encoded", lambda: boosting.encode(rows, levels, by=["variant"])), levels


def models(spark, folder, label, train):
    """Models by variant, trained once per session; node tables are small."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _MODELS:
        _MODELS[key] = train()
    return _MODELS[key]


def split_models(spark, folder):
    """Both variants with all quantiles, in one boosting loop."""
    return models(spark, folder, "split", lambda: boosting.train_variants(split_rows(spark, folder)[0], BOTH, "label", **FITTING))


def predictions(spark, folder, roles=("val", "test")):
    """Rows of the main split with p10, p50, p90 of both variants, one row per variant; ends never cross."""
    def build():
        rows = split_rows(spark, folder)[0].filter(F.col("role").isin("val", "test"))
        scored = boosting.score_trees(rows, split_models(spark, folder), variant="variant")
        scale = {n: F.when(F.col("variant") == "hybrid", trend.rebuild(f"log_{n}")).otherwise(F.expm1(f"log_{n}")) for n in NAMES}
        out = scored.withColumns({n: F.greatest(c, F.lit(0.0)) for n, c in scale.items()})
        return out.select("variant", "role", *KEYED, TARGET, *NAMES)

    return V.once(spark, folder, "split-predictions", build).filter(F.col("role").isin(*roles))


def adjusted(spark, folder):
    """Test rows of both variants, calibrated on their validation rows."""
    by = ["variant", "compute_type"]
    adj = conformal.conformal_adjustments(predictions(spark, folder, ["val"]), by=by)
    return conformal.apply_conformal(predictions(spark, folder, ["test"]), adj, by=by)


@query("quantile_boosting", "p10 p50 p90", 6)
def quantile_boosting(spark, folder):
    """Learned quantiles of the residual ratio on the test window, back on the scale of the trend."""
    return predictions(spark, folder, ["test"]).filter("variant = 'hybrid'").select(*KEYED, TARGET, *NAMES)


@query("level_boosting", "p10 p50 p90", 6)
def level_boosting(spark, folder):
    """Learned quantiles of the level itself, on a log scale."""
    return predictions(spark, folder, ["test"]).filter("variant = 'level'").select(*KEYED, TARGET, *NAMES)


@query("boosting_validation", "pinball_p10 pinball_p50 pinball_p90", 6)
def boosting_validation(spark, folder):
    """Pinball losses on validation and test rows: both learned models and the weekday profile."""
    learned = predictions(spark, folder)
    base = V.hybrid(spark, folder, S.TEST_END, S.TRAIN_END)
    role = F.when(F.col(DATE) <= F.lit(S.VAL_END).cast("date"), "val").otherwise("test")
    base = base.select(F.lit("profile").alias("variant"), role.alias("role"), *KEYED, TARGET, *NAMES)
    rows = learned.unionByName(base).groupBy(F.col("variant").alias("model"), "role")
    return rows.agg(*[accuracy.pinball(n, a).alias(f"pinball_{n}") for n, a in QUANTILES.items()], F.count(F.lit(1)).alias("n"))


@query("boosting_evaluation", "mape_p50 bias_pct coverage_p10_p90 mae rmse", 5)
def boosting_evaluation(spark, folder):
    """Test metrics of both learned models with calibrated intervals: the whole recipe on the main split."""
    return backtest.metrics(adjusted(spark, folder), [F.col("variant").alias("model")])


@query("boosting_comparison", "mape_first mape_second delta", 5)
def boosting_comparison(spark, folder):
    """The level model against the hybrid one, per series, with a flag at one point."""
    wide = predictions(spark, folder, ["test"]).groupBy(*KEYED).agg(F.first(TARGET).alias(TARGET), *[F.max(F.when(F.col("variant") == v, F.col("p50"))).alias(v) for v in BOTH])
    return accuracy.compare_models(wide, "level", "hybrid")


@query("load_boosters", "p10 p50 p90", 6)
def load_boosters(spark, folder):
    """The hybrid model stored as JSON parts, loaded again, and its calibrated, uncrossed forecast of the test window."""
    path = new_path(spark, "boosters")
    rows, levels = split_rows(spark, folder)
    model = split_models(spark, folder)["hybrid"]
    own = predictions(spark, folder, ["val"]).filter("variant = 'hybrid'")
    names = feature_columns(feature_rows(spark, folder))
    parts = {
        "trends": V.fitted_profile(spark, folder)[0].drop("uncapped_rate"),
        "levels": levels.filter("variant = 'hybrid'").drop("variant"),
        "conformal": conformal.conformal_adjustments(own).drop("n"),
        "features": spark.createDataFrame(list(enumerate(model.features)), "position int, feature string"),
        **boosting.parts_of(model, spark),
    }
    runs.write_parts(parts, path)
    got = runs.load_parts(spark, path, list(parts))
    test = V.until(feature_rows(spark, folder), S.TEST_END, S.VAL_END).select(DATE, *names)
    scored = boosting.predict_hybrid(boosting.encode(test, got["levels"]), boosting.model_of(got), got["trends"])
    return conformal.serve(scored, got["conformal"]).select(*KEYED, *NAMES)


# --- recursion ---


def _ahead(spark, folder, start, days, trends, levels, by=()):
    """Static features of the horizon of every series known by ``start``."""
    known = V.panel(spark, folder).filter(F.col(DATE) < F.lit(start).cast("date"))
    rows = P.scaffold(known, start, days)
    if by:
        rows = rows.join(F.broadcast(trends.select(*by).distinct()))
    return recursion.static_features(rows, V.panel_holidays(spark, folder), trends, levels, V._panel_origin(spark, folder), by)


@query("recursive_forecast", "p10 p50 p90", 6)
def recursive_forecast(spark, folder):
    """The planning horizon day by day, each day's P50 feeding the lags of the days after it."""
    levels = split_rows(spark, folder)[1].filter("variant = 'hybrid'").drop("variant")
    horizon = _ahead(spark, folder, S.HORIZON_START, S.HORIZON_DAYS, V.fitted_profile(spark, folder)[0], levels)
    return recursion.recursive_forecast(V.panel(spark, folder), horizon, split_models(spark, folder)["hybrid"], S.HORIZON_START, S.HORIZON_DAYS)


TEST_START = "2001-01-01"
TEST_DAYS = 181


def _both_ways(spark, folder):
    """Test rows with the recursive forecast from the end of validation and the single-step one."""
    def build():
        levels = split_rows(spark, folder)[1].filter("variant = 'hybrid'").drop("variant")
        horizon = _ahead(spark, folder, TEST_START, TEST_DAYS, V.fitted_profile(spark, folder)[0], levels)
        fed = recursion.recursive_forecast(V.panel(spark, folder), horizon, split_models(spark, folder)["hybrid"], TEST_START, TEST_DAYS)
        return recursion.compared(fed, predictions(spark, folder, ["test"]).filter("variant = 'hybrid'"), V.until(V.panel(spark, folder), S.TEST_END, S.VAL_END))

    return V.once(spark, folder, "both-ways", build)


@query("recursive_degradation", "single_step_mape recursive_mape degradation_points", 5)
def recursive_degradation(spark, folder):
    """What feeding on its own forecasts costs: overall, by type, by segment."""
    rows = _both_ways(spark, folder)
    member = F.array(F.struct(F.lit("overall").alias("dimension"), F.lit("all").alias("member")), *[F.struct(F.lit(k).alias("dimension"), F.col(k).alias("member")) for k in KEYS])
    return recursion.degradation(rows.select("*", F.inline(member)), ["dimension", "member"])


@query("recursive_horizon", "mape", 5)
def recursive_horizon(spark, folder):
    """Error of the recursive forecast by days into the future."""
    return accuracy.horizon_accuracy(_both_ways(spark, folder), F.lit(TEST_START).cast("date"), "recursive").filter("rule = 'left'").drop("rule")


def _cap_models(spark, folder):
    """A growing measure under every cap: rows, trends, levels and models from one boosting loop, one per cap and one of the level."""
    def rows():
        start = V._panel_origin(spark, folder)
        grown = V.panel(spark, folder).withColumn(TARGET, F.col(TARGET) * F.exp(S.GROWTH_PER_DAY * F.datediff(DATE, start)))
        return V.until(grown, S.TEST_END)

    usage = V.once(spark, folder, "grown", rows)
    start = V._panel_origin(spark, folder)

    def fits():
        free = trend.fit_trends(V.until(usage, S.TRAIN_END), None, origin=start)
        listed = F.array(*[F.struct(F.lit(c).alias("cap"), F.lit(trend.daily_cap(c)).alias("_most")) for c in S.CAPS])
        return free.select("*", F.inline(listed)).withColumn("daily_growth_rate", F.least("uncapped_rate", "_most")).drop("_most")

    trends = V.once(spark, folder, "cap-trends", fits)

    def build():
        table = features.build_features(usage, V.panel_holidays(spark, folder), origin=start, exact_dates=True)
        table = backtest.assign_role(table, S.TRAIN_END, S.VAL_END).select("*", F.explode(F.array(*[F.lit(c) for c in S.CAPS])).alias("cap"))
        out = trend.with_ratio(trend.with_trend(table, trends, ["cap", *KEYS]))
        hybrid = out.withColumns({"variant": F.col("cap").cast("string"), "label": F.ln("ratio")})
        level = out.filter(F.col("cap") == S.NEW_CAP).withColumns({"variant": F.lit("level"), "label": F.log1p(F.col(TARGET))})
        return hybrid.unionByName(level).drop("ratio")

    labelled_rows = V.once(spark, folder, "cap-rows", build)
    levels = V.once(spark, folder, "cap-levels", lambda: boosting.category_levels(labelled_rows.filter("role = 'fit'"), "label", by=["variant"]))
    ready = V.once(spark, folder, "cap-encoded", lambda: boosting.encode(labelled_rows, levels, by=["variant"]))
    names = [*[str(c) for c in S.CAPS], "level"]
    found = models(spark, folder, "caps", lambda: boosting.train_variants(ready, names, "label", quantiles={"p50": 0.5}, **FITTING))
    return usage, trends, levels, ready, found


def _cap_rows(spark, folder):
    """Test rows under every cap, single-step and recursive."""
    def build():
        usage, trends, levels, ready, found = _cap_models(spark, folder)
        hybrid = levels.filter("variant != 'level'").withColumn("cap", F.col("variant").cast("double")).drop("variant")
        horizon = _ahead(spark, folder, TEST_START, TEST_DAYS, trends, hybrid, ["cap"])
        fed = recursion.recursive_forecast(usage, horizon, found, TEST_START, TEST_DAYS, variant="cap")
        scored = boosting.score_trees(ready.filter("role = 'test' AND variant != 'level'"), found, variant="variant")
        return recursion.compared(fed, boosting.hybrid_scale(scored, ["p50"]), V.until(usage, S.TEST_END, S.VAL_END), ["cap"])

    return V.once(spark, folder, "cap-compared", build)


@query("recursive_cap_sweep", "single_step_mape recursive_mape degradation_points", 5)
def recursive_cap_sweep(spark, folder):
    """Single-step and recursive error under every cap, over all series and for the watched one."""
    ct, seg = S.WATCHED
    watched = (F.col(KEYS[0]) == ct) & (F.col(KEYS[1]) == seg)
    rows = _cap_rows(spark, folder).select("*", F.explode(F.when(watched, F.array(F.lit("all"), F.lit("watched"))).otherwise(F.array(F.lit("all")))).alias("series"))
    return recursion.degradation(rows, ["cap", "series"])


@query("cap_verdict", "single_step_cost recursive_cost", 5)
def cap_verdict(spark, folder):
    """Whether the cost of the tighter cap compounds, is absorbed or stays the same for the watched series."""
    ct, seg = S.WATCHED
    rows = _cap_rows(spark, folder).filter((F.col(KEYS[0]) == ct) & (F.col(KEYS[1]) == seg))
    return recursion.cap_verdict(recursion.degradation(rows, ["cap"]), S.OLD_CAP, S.NEW_CAP)


# --- importance, on the growing measure ---


def _pair(spark, folder):
    """The level model and the hybrid one under the shipped cap, of the same growing measure."""
    found = _cap_models(spark, folder)[-1]
    return {"level": found["level"], "hybrid": found[str(S.NEW_CAP)]}


@query("importance_shift", "first_pct second_pct shift", 6)
def importance_shift(spark, folder):
    """The largest changes of feature importance from the level model to the hybrid one."""
    found = _pair(spark, folder)
    return boosting.importance_shift(boosting.importance(found["level"], spark), boosting.importance(found["hybrid"], spark))


@query("feature_importance", "gain_pct split_pct", 6)
def feature_importance(spark, folder):
    """Share of gain and of splits of every feature, in both models."""
    own = [boosting.importance(m, spark).select(F.lit(v).alias("model"), "*") for v, m in _pair(spark, folder).items()]
    return own[0].unionByName(own[1])


@query("permutation_importance", "loss_increase plain_loss", 8)
def permutation_importance(spark, folder):
    """Rise of the hybrid model's P50 loss on all fitted rows when one feature's values are dealt out anew."""
    ready = _cap_models(spark, folder)[3]
    rows = ready.filter((F.col("variant") == str(S.NEW_CAP)) & (F.col("role") == "fit"))
    return boosting.permutation_importance(rows, _pair(spark, folder)["hybrid"], "label")


# --- learned folds ---


@query("boosted_folds", "mape mae", 4)
def boosted_folds(spark, folder):
    """Both learned variants over the second fold table, folds side by side, with the rounds each kept.

    One boosting loop serves all folds; each stops on the tail of its own training window, never on its test rows.
    """
    def build():
        rows = backtest.assign_folds(feature_rows(spark, folder), S.LATER_FOLDS, S.FOLD_VAL_DAYS).drop("train_end", "test_end")
        rows = written(rows, "fold-features")
        trends = written(trend.fit_trends(rows.filter("role = 'fit'"), keys=["fold", *KEYS], origin=V._panel_origin(spark, folder)), "fold-trends")
        return labelled(rows, trends, ["fold"])

    rows = V.once(spark, folder, "fold-labelled", build)
    levels = V.once(spark, folder, "fold-levels", lambda: boosting.category_levels(rows.filter("role = 'fit'"), "label", by=["fold", "variant"]))
    ready = V.once(spark, folder, "fold-encoded", lambda: boosting.encode(rows, levels, by=["fold", "variant"]).withColumn("task", F.concat_ws("/", "fold", "variant")))
    tasks = [f"{f}/{v}" for f, _, _ in S.LATER_FOLDS for v in BOTH]
    found = models(spark, folder, "folds", lambda: boosting.train_variants(ready, tasks, "label", quantiles={"p50": 0.5}, variant="task", **FITTING))
    scored = boosting.score_trees(ready.filter("role = 'test'"), found, variant="task")
    p50 = F.greatest(F.when(F.col("variant") == "hybrid", trend.rebuild("log_p50")).otherwise(F.expm1("log_p50")), F.lit(0.0))
    kept = F.create_map(*[x for t, m in found.items() for x in (F.lit(t), F.lit(m.rounds["p50"]))])
    return scored.withColumn("p50", p50).groupBy("fold", F.col("variant").alias("model")).agg(
        accuracy.mape().alias("mape"), accuracy.mae().alias("mae"), F.count(F.lit(1)).alias("n"), F.max(kept[F.col("task")]).alias("rounds_kept"),
    )
