"""Fixed contracts of every table, as DDL strings."""

RECORD = (
    "value: double, "
    "parameter: struct<name: string>, "
    "period: struct<label: string, datetimeTo: struct<utc: string>>"
)

ENVELOPE = (
    "sensor_id string, interval string, date_from string, date_to string, "
    f"count bigint, results array<struct<{RECORD}>>"
)

# One schema accepts both layouts: envelopes fill `results`, flat documents fill the
# record fields at top level.
RAW = (
    f"{ENVELOPE}, value double, parameter struct<name: string>, "
    "period struct<label: string, datetimeTo: struct<utc: string>>, _corrupt string"
)

METRICS = "model string, rmse double, mae double, r2 double"

LAGS = 24
LAG_COLUMNS = [f"lag_{i}" for i in range(1, LAGS + 1)]
CALENDAR_COLUMNS = ["hour", "day_of_week", "month"]
FEATURE_COLUMNS = CALENDAR_COLUMNS + LAG_COLUMNS
SERIES_KEY = ["sensor_id", "datetime"]
