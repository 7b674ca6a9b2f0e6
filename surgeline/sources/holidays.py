"""Holiday calendar from rules."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published US holiday rules.
FIXED = [
    ("New Year's Day", 1, 1),
    ("Independence Day", 7, 4),
    ("Veterans Day", 11, 11),
    ("Christmas Day", 12, 25),
]
NTH_WEEKDAY = [
    ("MLK Day", 1, "MON", 3),
    ("Presidents' Day", 2, "MON", 3),
    ("Labor Day", 9, "MON", 1),
    ("Columbus Day", 10, "MON", 2),
    ("Thanksgiving", 11, "THU", 4),
]
MAJOR = ["Christmas Day", "Thanksgiving", "Independence Day", "New Year's Day"]
MODERATE = ["Memorial Day", "Labor Day", "Day After Thanksgiving"]


def _nth(year, month, weekday, n):
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def holiday_rules(year):
    """Array of (date, holiday_name) structs for the year in a Column."""
    days = [(F.make_date(year, F.lit(m), F.lit(d)), name) for name, m, d in FIXED]
    days += [(_nth(year, m, wd, n), name) for name, m, wd, n in NTH_WEEKDAY]
    last_of_may = F.make_date(year, F.lit(5), F.lit(31))
    days.append((F.next_day(F.date_sub(last_of_may, 7), "MON"), "Memorial Day"))
    days.append((F.date_add(_nth(year, 11, "THU", 4), 1), "Day After Thanksgiving"))
    return F.array(*[F.struct(d.alias("date"), F.lit(n).alias("holiday_name")) for d, n in days])


def holiday_calendar(dates: DataFrame, date="date", extra_years: int = 1) -> DataFrame:
    """Holidays of every year ``dates`` spans plus ``extra_years`` for the forecast period."""
    span = dates.agg(F.year(F.min(date)).alias("y0"), F.year(F.max(date)).alias("y1"))
    return (
        span.select(F.explode(F.sequence("y0", F.col("y1") + extra_years)).alias("year"))
        .select(F.inline(holiday_rules(F.col("year"))))
        .select("date", "holiday_name")
    )


def with_tier(holidays: DataFrame) -> DataFrame:
    name = F.col("holiday_name")
    return holidays.withColumn(
        "tier",
        F.when(name.isin(MAJOR), "major").when(name.isin(MODERATE), "moderate").otherwise("minor"),
    )
