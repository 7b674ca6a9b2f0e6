"""Bounded samples of labelled rows for fitting a classifier."""

import math

from pyspark.sql import functions as F


def bounded_sample(df, label, key, per_label, seed=0):
    """About ``per_label`` rows of each label, chosen by a hash of ``key``; all rows of a rarer label.

    The labels are counted, so their number must be small. What is returned holds at most
    1.2 * per_label + 100 rows of a label, however large ``df`` is, up to the spread of the hash.
    """
    counts = {r[label]: r["count"] for r in df.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    scale = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(scale))
    keep = F.lit(False)
    for value, n in counts.items():
        share = min(scale, math.ceil(scale * per_label / n))
        keep = keep | ((F.col(label) == F.lit(value)) & (draw < share))
    return df.filter(keep), counts
