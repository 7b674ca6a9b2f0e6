"""Ranks over whole tables without sorting them in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PER_BUCKET = 50_000  # rows of a bucket that is sorted by one task


def global_rank(df: DataFrame, draw: str, *ties: str, by=(), out="rank", per_bucket=PER_BUCKET) -> DataFrame:
    """``df`` with ``out``: place of each row (from 0) among all rows of its group, by ``draw`` and then ``ties``.

    ``draw`` is a 64-bit hash, so its high bits cut the rows into buckets of even size that are in order
    themselves. Rows are numbered inside their bucket; buckets are counted and added up, a row per bucket.
    """
    by = list(by)
    n = df.count()
    bits = max(0, (max(1, n // per_bucket) - 1).bit_length())
    # the sign bit makes signed numbers rise from the least to the greatest
    bucket = F.shiftright(F.col(draw), 64 - bits) if bits else F.lit(0).cast("long")
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(draw, *ties))
    placed = rows.withColumn("_place", inside).join(before, [*by, "_bucket"])
    return placed.withColumn(out, F.col("_before") + F.col("_place") - 1).drop("_bucket", "_n", "_before", "_place")
