"""Quantile models by gradient boosting on Spark ML trees.

Each round fits one Spark ML tree per quantile to the sign of the pinball gradient and then gives
every leaf the quantile of the residuals in it. Growing trees and reducing residuals are Spark
jobs; the driver only ever holds the trees and one number per leaf.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from surgeline.functions.exprs import clip
from surgeline.functions.ranks import global_rank
from surgeline.operators.trend import rebuild, with_trend
from surgeline.schema import DATE, KEYS, NUMERIC_FEATURES, QUANTILES, TARGET
from surgeline.session import new_path, remove, written

MISSING = -1.0  # below every usage value, so one split sends missing values their own way
LEVELS = ["type_level", "segment_level", "series_level"]
MODEL_FEATURES = LEVELS + NUMERIC_FEATURES
NODE_COLUMNS = ["quantile", "tree", "node", "feature", "threshold", "left", "right", "value", "gain"]
NODE_SCHEMA = (
    "quantile string, tree int, node int, feature int, threshold double, "
    "left int, right int, value double, gain double"
)


@dataclass
class QuantileTrees:
    """Trees of all quantiles as node tables; small enough to ship to every task."""

    features: list
    base: dict
    nodes: pd.DataFrame
    rounds: dict
    history: list = field(default_factory=list)

    def stacked(self, quantile: str):
        """Node tables of one quantile padded to (trees, nodes) arrays."""
        part = self.nodes[self.nodes["quantile"] == quantile]
        trees, size = self.rounds[quantile], max(int(part["node"].max()) + 1, 1) if len(part) else 1
        out = {c: np.zeros((trees, size), t) for c, t in
               [("feature", int), ("threshold", float), ("left", int), ("right", int), ("value", float)]}
        for c, table in out.items():
            table[part["tree"].to_numpy(), part["node"].to_numpy()] = part[c].to_numpy()
        return out

    def depth(self) -> int:
        return int(np.ceil(np.log2(max(self.nodes["node"].max() + 2, 2)))) + 1 if len(self.nodes) else 0

    def compiled(self):
        return {q: (self.base[q], self.stacked(q)) for q in self.base}

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)


def walk(x: np.ndarray, compiled, max_depth: int) -> np.ndarray:
    """Sum of leaf values over all trees for a (rows, features) block."""
    base, t = compiled
    trees = t["feature"].shape[0]
    if trees == 0:
        return np.full(len(x), base)
    at = np.zeros((len(x), trees), dtype=int)
    tree = np.arange(trees)
    row = np.arange(len(x))[:, None]
    for _ in range(max_depth):
        go_left = x[row, t["feature"][tree, at]] <= t["threshold"][tree, at]
        at = np.where(go_left, t["left"][tree, at], t["right"][tree, at])
    return base + t["value"][tree, at].sum(axis=1)


# --- encoding -----------------------------------------------------------------------------------


def category_levels(fit: DataFrame, label: str, keys=KEYS, by=()) -> DataFrame:
    """Mean label per series, type and segment on the training rows, within each group of ``by``.

    A numeric level orders categories the way a regression tree would, needs no list of categories
    on the driver and works for any number of series.
    """
    per_series = fit.groupBy(*by, *keys).agg(F.sum(label).alias("_s"), F.count(label).alias("_n"))
    out = per_series.select(*by, *keys, (F.col("_s") / F.col("_n")).alias("series_level"))
    for key, name in zip(keys, ["type_level", "segment_level"]):
        level = per_series.groupBy(*by, key).agg((F.sum("_s") / F.sum("_n")).alias(name))
        out = out.join(level, [*by, key])
    return out


def encode(df: DataFrame, levels: DataFrame, keys=KEYS, by=()) -> DataFrame:
    """Model input: category levels, numeric features as doubles, missing values marked."""
    out = df.join(levels, [*by, *keys], "left")
    cols = {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in NUMERIC_FEATURES if c in df.columns}
    cols |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in LEVELS}
    return out.withColumns(cols)


# --- training -----------------------------------------------------------------------------------


def _nodes(model, quantile, tree_no):
    """Node rows of one fitted tree; a leaf points to itself and has no value yet."""
    rows = []

    def visit(node):
        me = len(rows)
        rows.append(None)
        if node.subtreeDepth() == 0:
            rows[me] = [quantile, tree_no, me, 0, np.inf, me, me, 0.0, 0.0]
        else:
            split = node.split()
            left, right = visit(node.leftChild()), visit(node.rightChild())
            rows[me] = [quantile, tree_no, me, split.featureIndex(), split.threshold(), left, right, 0.0, node.gain()]
        return me

    visit(model._java_obj.trees()[0].rootNode())
    return rows


def leaves(df: DataFrame, trees: dict, names) -> DataFrame:
    """Add ``leaf_<quantile>``: the node in which a row ends in its variant's tree, NULL where there is none.

    ``trees`` maps (variant, quantile) to node rows. Every row walks the trees of its own variant only.
    """
    tables = {task: [np.array(c) for c in zip(*[(r[3], r[4], r[5], r[6]) for r in rows])] for task, rows in trees.items()}
    shipped = df.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf(", ".join(f"{n} int" for n in names))
    def find(x: pd.Series, which: pd.Series) -> pd.DataFrame:
        out = {n: np.full(len(x), -1, np.int32) for n in names}
        block = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        for (v, n), (feature, threshold, left, right) in shipped.value.items():
            own = np.flatnonzero((which == v).to_numpy())
            at = np.zeros(len(own), int)
            while len(own):
                to = np.where(block[own, feature[at]] <= threshold[at], left[at], right[at])
                if (to == at).all():
                    break
                at = to
            out[n][own] = at
        return pd.DataFrame(out)

    found = df.withColumn("_leaf", find("x", "variant"))
    return found.select("*", *[F.when(F.col("_leaf")[n] >= 0, F.col("_leaf")[n]).alias(f"leaf_{n}") for n in names]).drop("_leaf")


def train_quantile_trees(rows: DataFrame, is_val, label: str, features=MODEL_FEATURES, quantiles=QUANTILES, **options) -> QuantileTrees:
    """One model: ``train_variants`` with a single variant.

    ``is_val`` is a Column telling validation rows from training rows, so that the features are
    computed once for both.
    """
    role = F.when(is_val, "val").otherwise("fit")
    rows = rows.select("*", F.lit("only").alias("_variant"), role.alias("_role"))
    return train_variants(rows, ["only"], label, features, quantiles, variant="_variant", role="_role", **options)["only"]


def train_variants(
    rows: DataFrame,
    variants: list[str],
    label: str,
    features=MODEL_FEATURES,
    quantiles=QUANTILES,
    variant="variant",
    role="role",
    rounds=2000,
    rate=0.2,
    depth=5,
    min_leaf=50,
    patience=50,
    feature_share="0.8",
    write_every=8,
    seed=42,
) -> dict[str, QuantileTrees]:
    """Boost the models of several variants (folds, caps, labels) in one loop.

    ``rows`` has a row per variant and observation; ``role`` says ``fit`` or ``val``, rows of any other role are not
    looked at. Each round grows one tree for every variant and quantile that still learns, side by side. A
    quantile stops on its own when it did not improve for ``patience`` validation rounds, or after ``rounds``; its trees after the best
    validation round are dropped, all of them if none is better than the constant. Without
    validation rows nothing can stop early: ``rounds`` are run and kept.

    Predictions so far are written every ``write_every`` rounds, and what was written before is removed.
    """
    names = list(quantiles)
    spark = rows.sparkSession
    rows = rows.filter(F.col(label).isNotNull() & F.col(role).isin("fit", "val") & F.col(variant).isin(*variants))
    rows = rows.select(F.col(variant).alias("variant"), (F.col(role) == "val").alias("is_val"), *features, F.col(label).alias("y"))
    made = [rows_path := new_path(spark, "boost")]
    rows.write.parquet(rows_path)
    rows = spark.read.schema(rows.schema).parquet(rows_path)
    start = rows.filter(~F.col("is_val")).groupBy("variant").agg(
        *[F.percentile_approx("y", quantiles[n], 10_000).alias(n) for n in names]
    )
    base = {r["variant"]: {n: float(r[n]) for n in names} for r in start.collect()}
    variants = [v for v in variants if v in base]  # one without rows to learn from has no model
    constant = F.create_map(*[x for v in variants for x in (F.lit(v), F.struct(*[F.lit(base[v][n]).alias(n) for n in names]))])
    packed = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    state = rows.filter(F.col("variant").isin(*variants)).select(
        "variant", "is_val", packed, "y", *[constant[F.col("variant")][n].alias(n) for n in names]
    ).persist(StorageLevel.MEMORY_AND_DISK)

    def validation_loss(frame):
        gap = {n: F.col("y") - F.col(n) for n in names}
        losses = [F.avg(F.greatest(gap[n] * quantiles[n], gap[n] * (quantiles[n] - 1))).alias(n) for n in names]
        found = {r["variant"]: r for r in frame.filter("is_val").groupBy("variant").agg(*losses).collect()}
        return {(v, n): found[v][n] if v in found else None for v in variants for n in names}

    # the constant alone counts as round 0, so that trees are kept only if they help
    tables, losses, first = [], [], validation_loss(state)
    best = {k: (np.inf if loss is None else loss, 0) for k, loss in first.items()}
    learning = list(best)
    pool = ThreadPoolExecutor(max(1, min(8, len(learning))))
    try:
        for r in range(rounds):
            if not learning:
                break

            def grow(task, state=state, r=r):
                v, name = task
                a = quantiles[name]
                gradient = F.when(F.col("y") > F.col(name), F.lit(a)).otherwise(F.lit(a - 1.0))
                forest = RandomForestRegressor(
                    featuresCol="v", labelCol="g", bootstrap=False, featureSubsetStrategy=feature_share, maxDepth=depth,
                    minInstancesPerNode=min_leaf, maxBins=64, seed=seed + r,
                )
                own = state.filter(~F.col("is_val") & (F.col("variant") == v))
                return _nodes(forest.fit(own.select(array_to_vector("x").alias("v"), gradient.alias("g"))), name, r)

            trees = dict(zip(learning, pool.map(inheritable_thread_target(spark)(grow), learning)))
            leafed = leaves(state, trees, names)
            residuals = F.array(
                *[F.struct(F.lit(n).alias("q"), F.col(f"leaf_{n}").alias("leaf"), (F.col("y") - F.col(n)).alias("e")) for n in names]
            )
            per_leaf = (
                leafed.filter(~F.col("is_val"))
                .select("variant", F.inline(residuals))
                .filter(F.col("leaf").isNotNull())
                .groupBy("variant", "q", "leaf")
                .agg(F.percentile_approx("e", [quantiles[n] for n in names], 2_000).alias("v"))
                .collect()
            )
            values = {task: {} for task in learning}
            for row in per_leaf:
                values[row["variant"], row["q"]][row["leaf"]] = rate * float(row["v"][names.index(row["q"])])
            for task, nodes in trees.items():
                for node in nodes:
                    node[7] = values[task].get(node[2], 0.0)
                    tables.append((task[0], *node))
            moved = []
            for n in names:
                step = F.lit(None).cast("double")
                for v in variants:
                    if own := values.get((v, n)):
                        steps = F.array(*[F.lit(own.get(i, 0.0)) for i in range(max(own) + 1)])
                        step = F.when(F.col("variant") == v, F.get(steps, F.col(f"leaf_{n}"))).otherwise(step)
                moved.append((F.col(n) + F.coalesce(step, F.lit(0.0))).alias(n))
            new = leafed.select("variant", "is_val", "x", "y", *moved)
            if (r + 1) % write_every == 0:
                made.append(path := new_path(spark, "boost"))
                new.write.parquet(path)
                new = spark.read.schema(new.schema).parquet(path)
            new = new.persist(StorageLevel.MEMORY_AND_DISK)
            loss = validation_loss(new)
            state.unpersist()
            state = new
            if (r + 1) % write_every == 0:
                for path in made[:-1]:
                    remove(spark, path)
                made = made[-1:]
            losses.append(loss)
            for k in learning:
                if loss[k] is None or loss[k] < best[k][0]:
                    best[k] = (np.inf if loss[k] is None else loss[k], r + 1)
            learning = [k for k in learning if r + 1 - best[k][1] < patience]
    finally:
        pool.shutdown()
        state.unpersist()
        for path in made:
            remove(spark, path)
    nodes = pd.DataFrame(tables, columns=["variant", *NODE_COLUMNS])
    out = {}
    for v in variants:
        kept = {n: best[v, n][1] for n in names}
        own = nodes[nodes["variant"] == v].drop(columns="variant")
        own = own[own["tree"] < own["quantile"].map(kept)].reset_index(drop=True)
        history = [{n: loss[v, n] for n in names} for loss in losses]
        out[v] = QuantileTrees(list(features), base[v], own, kept, history)
    return out


def parts_of(model: QuantileTrees, spark: SparkSession) -> dict[str, DataFrame]:
    """The model as tables to store. A leaf compares nothing, so its threshold is left out."""
    base = spark.createDataFrame([(q, b, model.rounds[q]) for q, b in model.base.items()], "quantile string, base double, rounds int")
    nodes = model.to_frame(spark).withColumn("threshold", F.when(F.col("left") != F.col("node"), F.col("threshold")))
    return {"base": base, "nodes": nodes}


def model_of(parts: dict[str, DataFrame]) -> QuantileTrees:
    """The model from its stored tables ``features``, ``base`` and ``nodes``."""
    names = [r["feature"] for r in parts["features"].orderBy("position").collect()]
    rows = parts["base"].orderBy("quantile").collect()  # a row per quantile
    nodes = parts["nodes"].fillna(np.inf, ["threshold"]).toPandas()
    return QuantileTrees(names, {r["quantile"]: r["base"] for r in rows}, nodes, {r["quantile"]: r["rounds"] for r in rows})


def trees_from_frame(frame: DataFrame, features, base) -> QuantileTrees:
    """Rebuild a model from its stored node table (a few thousand rows)."""
    nodes = frame.toPandas()
    kept = {q: int(nodes.loc[nodes["quantile"] == q, "tree"].max() + 1) if (nodes["quantile"] == q).any() else 0 for q in base}
    return QuantileTrees(list(features), base, nodes, kept)


# --- prediction ---------------------------------------------------------------------------------


def score_trees(df: DataFrame, model, prefix="log_", variant=None) -> DataFrame:
    """Add one raw prediction column per quantile; rows stay where they are, in Arrow batches.

    With ``variant``, a column, ``model`` maps its values to models; a row whose variant has none gets NULL.
    """
    models = model if variant else {"only": model}
    shipped = df.sparkSession.sparkContext.broadcast({v: (m.compiled(), m.depth()) for v, m in models.items()})
    first = next(iter(models.values()))
    names = list(first.base)

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(x: pd.Series, which: pd.Series) -> pd.DataFrame:
        out = {n: np.full(len(x), np.nan) for n in names}
        block = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        for v, (compiled, max_depth) in shipped.value.items():
            own = (which == v).to_numpy()
            for n in names:
                out[n][own] = walk(block[own], compiled[n], max_depth)
        return pd.DataFrame(out)

    packed = F.array(*[F.col(c).cast("double") for c in first.features])
    scored = df.withColumn("_s", score(packed, F.col(variant).cast("string") if variant else F.lit("only")))
    found = {n: F.when(~F.isnan(F.col("_s")[n]), F.col("_s")[n]) for n in names}
    return scored.select(*df.columns, *[c.alias(f"{prefix}{n}") for n, c in found.items()])


def hybrid_scale(rows: DataFrame, names, prefix="log_") -> DataFrame:
    """trend * exp(prediction), floored at zero, in place of the raw predictions."""
    out = rows.withColumns({n: clip(rebuild(f"{prefix}{n}"), 0.0) for n in names})
    return out.drop(*[f"{prefix}{n}" for n in names])


def level_scale(rows: DataFrame, names, prefix="log_") -> DataFrame:
    """Back from log1p of the level, floored at zero."""
    out = rows.withColumns({n: clip(F.expm1(f"{prefix}{n}"), 0.0) for n in names})
    return out.drop(*[f"{prefix}{n}" for n in names])


def predict_hybrid(encoded: DataFrame, model: QuantileTrees, trends: DataFrame) -> DataFrame:
    return hybrid_scale(score_trees(with_trend(encoded, trends), model), model.base)


def predict_level(encoded: DataFrame, model: QuantileTrees) -> DataFrame:
    return level_scale(score_trees(encoded, model), model.base)


# --- explanation --------------------------------------------------------------------------------


def importance(model: QuantileTrees, spark: SparkSession, quantile="p50") -> DataFrame:
    """Share of total gain and of splits per feature, in percent; all shares are 0 for a model without a split."""
    inner = model.to_frame(spark).filter((F.col("quantile") == quantile) & (F.col("left") != F.col("node")))
    stats = inner.groupBy("feature").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
    names = spark.createDataFrame([(i, n) for i, n in enumerate(model.features)], "feature int, name string")
    every = Window.partitionBy()  # one row per feature
    full = names.join(stats, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("splits", F.lit(0)).alias("splits")
    )
    share = lambda c: F.coalesce(F.col(c) / F.nullif(F.sum(c).over(every), F.lit(0)) * 100, F.lit(0.0))
    return full.select("feature", share("gain").alias("gain_pct"), share("splits").alias("split_pct"))


def importance_shift(first: DataFrame, second: DataFrame, k=5, share="gain_pct") -> DataFrame:
    """The k largest and k smallest changes of importance between two models, ties by name.

    A feature that only one model has counts as 0 in the other.
    """
    both = first.select("feature", F.col(share).alias("first_pct")).join(
        second.select("feature", F.col(share).alias("second_pct")), "feature", "full"
    ).fillna(0.0, ["first_pct", "second_pct"]).withColumn("shift", F.col("second_pct") - F.col("first_pct"))
    top = both.orderBy(F.col("shift").desc(), "feature").limit(k)
    low = both.orderBy(F.col("shift"), "feature").limit(k)
    return top.unionByName(low).distinct().orderBy("shift", "feature")


def permuted_features(rows: DataFrame, features, row="row", seed=42) -> DataFrame:
    """``row`` and ``mixed``, an array with one value per feature, each taken from another row.

    ``row`` numbers the rows from 0. Every feature has its own seeded permutation of all rows: a row gets the value of
    the row whose hash has that rank among all hashes of the feature. It does not depend on how rows are
    partitioned.
    """
    long = rows.select(row, F.posexplode(F.array(*[F.col(c).cast("double") for c in features])).alias("feature", "value"))
    drawn = long.withColumn("draw", F.xxhash64(F.lit(seed), "feature", row))
    ranked = global_rank(drawn, "draw", row, by=["feature"], out="rank")
    # a rank is the number of the row that gets the value, so every row gets one value of each feature
    gathered = ranked.groupBy(F.col("rank").alias(row)).agg(F.array_sort(F.collect_list(F.struct("feature", "value"))).alias("m"))
    return gathered.select(row, F.col("m.value").alias("mixed"))


def permutation_importance(
    encoded: DataFrame, model: QuantileTrees, label: str, quantile="p50", alpha=0.5, seed=42, order=(DATE, *KEYS)
) -> DataFrame:
    """Rise of the pinball loss when the values of one feature are dealt out anew, per feature.

    Each feature is permuted over all rows at once; ``order`` names a key of the rows, from which their numbers and the
    permutations follow. Losses are added up as decimals, so the result is the same for any partitioning.
    """
    names = list(model.features)
    known = encoded.filter(F.col(label).isNotNull())
    hashed = known.select(F.xxhash64(F.lit(seed), *order).alias("_k"), F.to_json(F.struct(*order)).alias("_o"),
                          F.array(*[F.col(n).cast("double") for n in names]).alias("x"), F.col(label).alias("y"))
    rows = written(global_rank(hashed, "_k", "_o", out="row").drop("_k", "_o"), "permutation-rows")
    mixed = permuted_features(rows.select("row", *[F.col("x")[i].alias(n) for i, n in enumerate(names)]), names, seed=seed)
    shipped = encoded.sparkSession.sparkContext.broadcast((model.stacked(quantile), model.base[quantile], model.depth()))
    width = len(names)

    @F.pandas_udf("array<double>")
    def losses(x: pd.Series, m: pd.Series, y: pd.Series) -> pd.Series:
        nodes, base, max_depth = shipped.value
        if not len(x):
            return pd.Series([], dtype=object)
        x, m, y = np.vstack(x.to_numpy()), np.vstack(m.to_numpy()), y.to_numpy(float)
        out = np.empty((len(x), width + 1))
        for j in range(width + 1):
            block = x
            if j < width:
                block = x.copy()
                block[:, j] = m[:, j]
            gap = y - walk(block, (base, nodes), max_depth)
            out[:, j] = np.maximum(alpha * gap, (alpha - 1) * gap)
        return pd.Series(list(out))

    per_row = rows.join(mixed, "row").select(losses("x", "mixed", "y").alias("l"))
    exact = per_row.select(F.element_at("l", -1).cast("decimal(28,12)").alias("plain"), F.posexplode(F.slice("l", 1, width)).alias("i", "shuffled"))
    sums = exact.groupBy("i").agg(F.sum("plain").alias("p"), F.sum(F.col("shuffled").cast("decimal(28,12)")).alias("s"), F.count(F.lit(1)).alias("n"))
    mean = lambda c: F.col(c).cast("double") / F.col("n")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    return sums.select(
        name.alias("feature"), ((F.col("s") - F.col("p")).cast("double") / F.col("n")).alias("loss_increase"), mean("p").alias("plain_loss"), "n"
    )


def seeded_sample(df: DataFrame, n: int, keys=(DATE, *KEYS), seed=42) -> DataFrame:
    """Repeatable sample of n rows without replacement: the n smallest digests of seed and key."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")
