"""Names shared by every operator."""

DATE = "date"
KEYS = ["compute_type", "customer_segment"]
TARGET = "compute_hours"
QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}

# The feature contract, in its published order.
CATEGORICAL = ["compute_type", "customer_segment", "series_id"]
CALENDAR = [
    "day_of_week", "month", "day_of_month", "week_of_year", "is_weekend",
    "quarter", "day_of_year", "day_of_quarter", "is_quarter_end",
]
HOLIDAY = ["is_holiday", "days_to_next_holiday", "days_from_last_holiday"]
LAGS = [1, 7, 14, 28, 365]
WINDOWS = [7, 28]
LAG_COLUMNS = [f"lag_{k}" for k in LAGS]
ROLLING_COLUMNS = [f"rolling_{s}_{w}" for w in WINDOWS for s in ("mean", "std")]
FEATURE_COLUMNS = (
    CATEGORICAL + CALENDAR + HOLIDAY + LAG_COLUMNS + ROLLING_COLUMNS + ["days_since_start"]
)
NUMERIC_FEATURES = [c for c in FEATURE_COLUMNS if c not in CATEGORICAL]
# A direct model for the next weeks cannot know yesterday; one for months ahead knows no lag at all.
NEAR_TERM_FEATURES = [
    c for c in FEATURE_COLUMNS
    if c not in ROLLING_COLUMNS and c not in ("lag_1", "lag_7", "lag_14")
]
LONG_HORIZON_FEATURES = [
    c for c in NEAR_TERM_FEATURES if c not in LAG_COLUMNS
]


def require_columns(df, columns):
    """Raise a ValueError naming the columns ``df`` lacks; otherwise return ``df``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def feature_columns(df, exclude=(DATE, TARGET)):
    """Every column but the excluded ones, in frame order."""
    return [c for c in df.columns if c not in exclude]
