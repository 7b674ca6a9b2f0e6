"""Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c):
    return F.col(c) if isinstance(c, str) else c


def clip(c, low=None, high=None):
    """Limit a value on either side. NULL stays NULL (plain least/greatest would skip it)."""
    c = col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def day_number(date="date"):
    """Days since 1970-01-01, the ordering key of calendar-exact window ranges."""
    return F.datediff(col(date), F.lit("1970-01-01").cast("date"))


def calendar_columns(date="date"):
    """The calendar block as a name -> Column mapping."""
    d = col(date)
    quarter_start = F.trunc(d, "quarter")
    quarter_last_day = F.last_day(F.add_months(quarter_start, 2))
    return {
        "day_of_week": F.weekday(d),
        "month": F.month(d),
        "day_of_month": F.dayofmonth(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "quarter": F.quarter(d),
        "day_of_year": F.dayofyear(d),
        "day_of_quarter": F.datediff(d, quarter_start) + 1,
        # "last ten days" counts the distance to the last day, so eleven dates qualify
        "is_quarter_end": (F.datediff(quarter_last_day, d) <= 10).cast("int"),
    }


def weekday_dummies(date="date", days=6):
    """One 0/1 column per weekday, Monday first; the last day is the base level."""
    return [(F.weekday(col(date)) == i).cast("int").alias(f"dow_{i}") for i in range(days)]


def series_id(keys=("compute_type", "customer_segment")):
    return F.concat_ws(" | ", *[F.col(k) for k in keys])


def half_even_thousands(c):
    return F.bround(col(c), -3)


def slug(c):
    """Lower case, runs of other characters become one underscore, none at the ends."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_"), "^_+|_+$", ""
    )


def split_list(c):
    """A "; "-delimited string as an array of trimmed items."""
    return F.transform(F.split(col(c), ";"), lambda x: F.trim(x))


def kilo(c):
    """12345.6 -> '12K'."""
    return F.concat(F.format_number(col(c) / 1000, 0), F.lit("K"))


def signed_percent(c):
    return F.format_string("%+.1f%%", col(c))


def horizon_bucket(days, edges, labels, closed="right", include_lowest=False) -> Column:
    """Label a day offset by interval. Values outside every interval give NULL."""
    d = col(days)
    out = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        if closed == "right":
            inside = (d > lo) & (d <= hi)
            if include_lowest and i == 0:
                inside = (d >= lo) & (d <= hi)
        else:
            inside = (d >= lo) & (d < hi)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out
