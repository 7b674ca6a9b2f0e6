"""Dates and small business tables of the registered queries.

The date range fits the given tables: 1995-01-02 to 2001-11-04.
"""

# Splits, folds and caps of the checked recipe, moved to the dates of the given tables.
TRAIN_END = "1999-12-31"
VAL_END = "2000-12-31"
TEST_END = "2001-06-30"
HORIZON_START = "2001-07-01"
HORIZON_DAYS = 184
RECENT_FROM = "2001-06-01"
LONG_RANGE_FROM = "2001-09-01"
SIXTY_DAYS_TO = "2001-08-29"
Q4_FIRST, Q4_LAST = "2001-10-01", "2001-12-31"
EFFICIENCY_TYPE, EFFICIENCY_FROM = "N", "2001-08-01"
# name, end of training, end of test; each calibrates on the last 90 days of its training window
FOLDS = [
    ("fold_1", "1998-12-31", "1999-06-30"),
    ("fold_2", "1999-06-30", "1999-12-31"),
    ("fold_3", "1999-12-31", "2000-06-30"),
]
# a second table, half a year later; its folds too keep a tail of the training window for stopping
LATER_FOLDS = [
    ("fold_1", "1999-06-30", "1999-12-31"),
    ("fold_2", "1999-12-31", "2000-06-30"),
    ("fold_3", "2000-06-30", "2000-12-31"),
]
FOLD_VAL_DAYS = 90
# learned models: bounded rounds, stopped early on validation rows
BOOST_ROUNDS, BOOST_RATE, BOOST_PATIENCE, BOOST_MIN_LEAF = 20, 0.2, 4, 50
OLD_CAP, NEW_CAP = 0.05, 0.06
WATCHED = ("N", "O")
CAPS = [0.04, 0.05, 0.06, 0.07, 10.0]  # the last one never binds

# Planned demand, sized to the given panel (about 25 to 400 a day and series); two deals share a long
# prefix and two hit one series.
# event_name, expected_date, compute_type, customer_segment, estimated_daily_hours, probability
DEALS = [
    ("Warehouse rollout north", "2001-07-19", "N", "O", 95.0, 0.90),
    ("Returns desk pilot", "2001-08-06", "R", "F", 34.0, 0.25),
    ("Regional distribution framework, phase one", "2001-08-27", "A", "F", 52.0, 0.65),
    ("Regional distribution framework, phase two", "2001-10-22", "A", "F", 71.0, 0.35),
    ("Spare parts call-off", "2001-09-03", "N", "O", 18.0, 0.80),
    ("Contract without a series", "2001-09-10", "X", "F", 10.0, 0.50),
]
DEAL_SCHEMA = (
    "event_name string, expected_date date, compute_type string, customer_segment string, "
    "estimated_daily_hours double, probability double"
)

# Calendar marks looked at in the given panel.
# event_date, event_end_date, event_type, event_name, affected_compute_types, affected_segments
EVENTS = [
    ("1995-09-05", "1995-10-02", "step_change", "Autumn price list", "N", "O"),
    ("1997-03-17", "1997-04-04", "step_change", "Carrier change", "A; R", "F"),
    ("1998-05-20", "1998-05-22", "spike", "Inventory days", "N", "O; F"),
    ("2000-01-31", "2000-02-01", "spike", "Ledger close", "R; A", "F"),
    ("1999-11-08", "1999-11-26", "churn", "Supplier leaves", "R", "F"),
]
EVENT_SCHEMA = (
    "event_date date, event_end_date date, event_type string, event_name string, "
    "affected_compute_types string, affected_segments string"
)

# event_name, compute_type, outage_start, outage_end, recovery_end
OUTAGES = [
    ("Dock closed", "N", "1996-06-11", "1996-06-14", "1996-06-20"),
    ("Dock closed", "R", "1996-06-11", "1996-06-12", "1996-06-16"),
    ("Strike", "A", "2000-03-01", "2000-03-07", "2000-03-10"),
]
OUTAGE_SCHEMA = "event_name string, compute_type string, outage_start date, outage_end date, recovery_end date"

# a clearly growing measure, since the given panel is flat
GROWTH_PER_DAY = 0.003


def frame(spark, rows, schema):
    """A small literal table; ISO strings become dates."""
    import datetime

    from pyspark.sql.types import DateType, _parse_datatype_string

    fields = _parse_datatype_string(schema).fields
    dates = {i for i, f in enumerate(fields) if isinstance(f.dataType, DateType)}
    typed = [tuple(datetime.date.fromisoformat(v) if i in dates else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(typed, schema)


def values(rows, names, dates=()):
    """The same literal table as SQL."""
    def lit(name, v):
        if name in dates:
            return f"DATE '{v}'"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v)

    body = ", ".join("(" + ", ".join(lit(n, v) for n, v in zip(names, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(names)})"
