import random

from pyspark.sql import functions as F

from surgeline.operators import boosting
from surgeline.schema import QUANTILES


def frame(spark, signal):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        a, b = rng.random(), rng.random()
        rows.append((a, b, signal * a + rng.gauss(0, 0.1), i % 4 == 0))
    return spark.createDataFrame(rows, "a double, b double, y double, val boolean")


def trained(spark, signal, rounds):
    df = frame(spark, signal)
    return df, boosting.train_quantile_trees(df, F.col("val"), "y", features=["a", "b"], rounds=rounds, min_leaf=10, rate=0.5)


def test_loss_falls_and_a_reloaded_model_scores_the_same(spark):
    df, model = trained(spark, 5.0, 3)
    assert model.history[-1]["p50"] < model.history[0]["p50"]
    assert all(k >= 1 for k in model.rounds.values())
    scored = boosting.score_trees(df, model).orderBy("a").collect()
    again = boosting.trees_from_frame(model.to_frame(spark), model.features, model.base)
    assert boosting.score_trees(df, again).orderBy("a").collect() == scored
    share = sum(r.y <= r.log_p90 for r in scored) / len(scored)
    assert 0.7 < share <= 1.0
    assert set(model.base) == set(QUANTILES)


def test_no_tree_is_kept_where_none_helps(spark):
    """Validation rows equal the training median, so for p50 the constant has no loss."""
    df = frame(spark, 0.0).withColumn("y", F.when(F.col("val"), 1.0).otherwise(F.floor(F.col("a") * 3).cast("double")))
    model = boosting.train_quantile_trees(df, F.col("val"), "y", features=["a", "b"], rounds=2, min_leaf=10)
    assert model.base["p50"] == 1.0 and model.rounds["p50"] == 0
    assert {r.log_p50 for r in boosting.score_trees(df, model).collect()} == {1.0}


def test_variants_stop_on_their_own_and_equal_each_alone(spark):
    """One loop over several variants gives the models that each variant gets alone."""
    parts = [frame(spark, s).coalesce(1).withColumn("variant", F.lit(v)) for v, s in (("flat", 0.0), ("steep", 5.0))]
    rows = parts[0].unionByName(parts[1]).withColumn("role", F.when(F.col("val"), "val").otherwise("fit")).withColumn("label", F.col("y"))
    options = {"features": ["a", "b"], "quantiles": {"p50": 0.5}, "rounds": 4, "min_leaf": 10, "rate": 0.5, "patience": 2, "write_every": 2}
    both = boosting.train_variants(rows, ["flat", "steep", "none"], "label", **options)
    assert set(both) == {"flat", "steep"} and both["steep"].rounds["p50"] == 4
    alone = boosting.train_variants(rows.filter("variant = 'steep'"), ["steep"], "label", **options)["steep"]
    assert both["steep"].base == alone.base and both["steep"].rounds == alone.rounds
    inner = lambda m: m.nodes[m.nodes["left"] != m.nodes["node"]][["tree", "feature"]].values.tolist()[:1]
    assert inner(both["steep"]) == inner(alone)
    scored = boosting.score_trees(rows.withColumn("variant", F.when(F.col("a") > 0.5, "none").otherwise(F.col("variant"))), both, variant="variant")
    assert {(r.variant, r.log_p50 is None) for r in scored.collect()} == {("none", True), ("flat", False), ("steep", False)}


def test_written_predictions_are_removed(spark, monkeypatch):
    import os

    from surgeline.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    trained(spark, 5.0, 1)
    assert not [n for n in set(os.listdir(shared_dir(spark))) - before if "-boost-" in n]


def test_stored_model_scores_the_same(spark, tmp_path):
    from surgeline.sources import runs

    df, model = trained(spark, 5.0, 2)
    parts = {"features": spark.createDataFrame(list(enumerate(model.features)), "position int, feature string"), **boosting.parts_of(model, spark)}
    runs.write_parts(parts, str(tmp_path / "parts"))
    again = boosting.model_of(runs.load_parts(spark, str(tmp_path / "parts"), list(parts)))
    assert again.features == model.features and again.base == model.base and again.rounds == model.rounds
    assert boosting.score_trees(df, again).orderBy("a").collect() == boosting.score_trees(df, model).orderBy("a").collect()


def test_importance_adds_up_and_ties_go_by_name(spark):
    _, model = trained(spark, 5.0, 2)
    shares = boosting.importance(model, spark).collect()
    assert abs(sum(r.gain_pct for r in shares) - 100) < 1e-9 and abs(sum(r.split_pct for r in shares) - 100) < 1e-9
    empty = boosting.QuantileTrees(["a", "b"], {"p50": 0.0}, model.nodes.iloc[:0], {"p50": 0})
    assert [(r.gain_pct, r.split_pct) for r in boosting.importance(empty, spark).collect()] == [(0.0, 0.0)] * 2
    names = "abcdefgh"
    first = spark.createDataFrame([(n, 12.5) for n in names], "feature string, gain_pct double")
    second = spark.createDataFrame([(n, {"c": 30.0, "d": 0.0}.get(n, 10.0)) for n in names[:-1]], "feature string, gain_pct double")
    got = [(r.feature, r.shift) for r in boosting.importance_shift(first, second, 2).collect()]
    assert got == [("d", -12.5), ("h", -12.5), ("a", -2.5), ("c", 17.5)]


def brute_permutation(rows, model, seed):
    """Loss with each column dealt out by sorted hashes, on plain lists; hashes come with the rows."""
    import numpy as np

    n, names = len(rows), model.features
    x = np.array([[r[c] for c in names] for r in rows])
    y = np.array([r["y"] for r in rows])
    loss = lambda b: np.maximum(0.5 * (y - f(b)), -0.5 * (y - f(b)))
    f = lambda b: boosting.walk(b, (model.base["p50"], model.stacked("p50")), model.depth())
    out = {}
    for j, name in enumerate(names):
        order = sorted(range(n), key=lambda i, j=j: (rows[i]["hashes"][j], i))
        mixed = x.copy()
        mixed[:, j] = x[order, j]  # the row with this number gets the value of the row whose hash has that rank
        out[name] = (loss(mixed) - loss(x)).sum() / n
    return out


def test_permutation_importance_equals_brute_force_for_any_partitioning(spark):
    df, model = trained(spark, 5.0, 2)
    keyed = df.withColumns({"date": F.lit("2000-01-01").cast("date"), "compute_type": F.col("a").cast("string"), "customer_segment": F.lit("x")})
    order = ("date", "compute_type", "customer_segment")
    got = [
        {r.feature: (r.loss_increase, r.plain_loss, r.n) for r in boosting.permutation_importance(keyed.repartition(n), model, "y", seed=3, order=order).collect()}
        for n in (1, 7)
    ]
    assert got[0] == got[1]
    known = sorted(keyed.withColumn("k", F.xxhash64(F.lit(3), *order)).collect(), key=lambda r: r.k)
    numbered = spark.createDataFrame([(i, *[r[c] for c in ("a", "b", "y")]) for i, r in enumerate(known)], "row long, a double, b double, y double")
    hashed = numbered.withColumn("hashes", F.array(*[F.xxhash64(F.lit(3), F.lit(j), "row") for j in range(2)])).orderBy("row").collect()
    want = brute_permutation(hashed, model, 3)
    for name, v in want.items():
        assert abs(got[0][name][0] - v) < 1e-9
    assert want["a"] > 10 * abs(want["b"])
