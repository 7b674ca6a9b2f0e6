"""Exact interpolated quantiles of groups of any size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeline.session import written

ACCURACY = 100_000
SMALL_TABLE = 10_000  # rows of a table of groups that is sent to every task


def spread_out(bounds: DataFrame) -> DataFrame:
    """``bounds``, a row per group, written once; marked for broadcast if it has few rows.

    With few groups one of them may hold most rows, which a shuffled join would put into one task;
    with many groups the table may be too large to send around.
    """
    table = written(bounds, "bounds")
    return F.broadcast(table) if table.count() <= SMALL_TABLE else table


def _grid(centre: float, slack: float):
    """Levels that lie closer the nearer they are to ``centre``, with both ends."""
    steps, step = [0.0], 2 * slack
    while step < 1:
        steps += [step, -step]
        step *= 3
    return sorted({0.0, 1.0, *[centre + s for s in steps if 0 < centre + s < 1]})


def exact_quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    level,
    centre: float,
    out: str = "quantile",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Linear-interpolated quantile of ``value`` per group, as ``keys + [out, n]``.

    ``level`` maps the row-count Column to the wanted level, so the level may depend on the group
    size; ``centre`` is the level it tends to for large groups.

    One group may hold most rows, so no group is sorted whole. A mergeable sketch of a grid of
    levels brackets the wanted rank in a group of any size: the bracket's ends lie further from the
    wanted level than the sketch can err, or are the least and the largest value. All values below the bracket
    collapse into one count before the shuffle, and only the distinct values inside it are ranked. The
    result is exact: the sketch decides what is looked at, never what is returned.
    """
    slack = 2.0 / accuracy
    grid = _grid(centre, slack)
    rows = df.filter(F.col(value).isNotNull())
    bounds = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(value, grid, accuracy).alias("_sketch")
    )
    wanted = level(F.col("n"))
    margin = F.lit(slack) + F.lit(2.0) / F.col("n")  # the sketch's error, and the two neighbouring ranks
    levels = F.array(*[F.lit(g) for g in grid])
    below = F.size(F.filter(levels, lambda g: g <= wanted - margin))
    above = F.size(F.filter(levels, lambda g: g >= wanted + margin))
    bounds = bounds.select(
        *keys,
        "n",
        F.element_at("_sketch", F.greatest(below, F.lit(1))).alias("_lo"),
        F.element_at("_sketch", F.least(F.lit(len(grid)) - above + 1, F.lit(len(grid)))).alias("_hi"),
        (wanted * (F.col("n") - 1)).alias("_h"),
    )
    bounds = spread_out(bounds)
    counted = (
        rows.join(bounds, keys)
        .filter(F.col(value) <= F.col("_hi"))
        .withColumn("_v", F.when(F.col(value) >= F.col("_lo"), F.col(value)))
        .groupBy(*keys, "n", "_h", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first())
    ranked = counted.withColumn("_end", F.sum("_c").over(upto))
    k0 = F.floor("_h")
    k1 = F.least(k0 + 1, F.col("n") - 1)

    def at(rank):
        return F.max(F.when((F.col("_end") > rank) & (F.col("_end") - F.col("_c") <= rank), F.col("_v")))

    picked = ranked.groupBy(*keys, "n", "_h").agg(at(k0).alias("_a"), at(k1).alias("_b"))
    found = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return picked.select(
        *keys,
        F.when(found, F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_h") - F.floor("_h")))
        .otherwise(F.raise_error(F.lit("rank outside its bracket")).cast("double"))
        .alias(out),
        "n",
    )
