"""Fixed values.

These must equal the reference's values for results to be equal; they are
stated here together, as plain text, in the order the reference uses them.
"""

# Run statuses of the audit log.
RUN_STATUSES = ["RUNNING", "SUCCESS", "FAILED", "SKIPPED"]

# Column defaults.
DEFAULT_WEATHER_SOURCE = "open-meteo"
DEFAULT_EVENT_SOURCE = "web"
UNKNOWN_COUNTRY = "UNKNOWN"

# Cleaning range for age (inclusive).
AGE_MIN, AGE_MAX = 0, 120

# The event type that carries revenue.
PURCHASE = "purchase"

# Quarantine reasons, first match wins; "other" is unreachable.
REJECT_MISSING_EMAIL = "missing_email"
REJECT_PURCHASE_MISSING_AMOUNT = "purchase_missing_amount"
REJECT_NEGATIVE_AMOUNT = "negative_amount"
REJECT_OTHER = "other"

# CHECK constraint names of the event fact.
CHK_EVENT_TYPE_NOT_BLANK = "chk_event_type_not_blank"
CHK_PURCHASE_AMOUNT = "chk_purchase_amount"
CHK_AMOUNT_NON_NEGATIVE = "chk_amount_non_negative"

# Hourly variables of a payload, in payload order.
HOURLY_VARS = ["temperature_2m", "precipitation", "windspeed_10m"]

# Forecast horizon (today ... today + 6 days = 168 hours).
HORIZON_DAYS = 6
FULL_WINDOW_HOURS = 168

# Post-load QC looks at runs started in [t, t + 2 hours].
QC_WINDOW_HOURS = 2

# Message of a run skipped by the horizon guard.
SKIP_MESSAGE = "No new hours – watermark beyond forecast window"

# Export CSV header, in file order.
EXPORT_COLUMNS = ["location_name", "location_id", "ts", "temperature_2m", "precipitation",
                  "windspeed_10m", "source", "ingested_at", "run_id"]

# Text read as NULL when loading landed CSV.
NULL_MARKERS = ("", "NULL")
