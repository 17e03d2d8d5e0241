"""Fixed values that other producers and consumers of the same data rely on."""

from __future__ import annotations

# --- fixed values: alert levels and their bounds -------------------------------------
LEVEL_0 = "level_0"
LEVEL_1 = "level_1"
LEVEL_2 = "level_2"
LEVELS = (LEVEL_0, LEVEL_1, LEVEL_2)
UNKNOWN_LEVEL = "unknown"
WIND_BOUNDS = (10.0, 20.0)
HEAT_BOUNDS = (25.0, 35.0)
HIGH_WIND = 10.0
HOT_DAY = 30.0

# --- fixed values: places -------------------------------------------------------------
UNKNOWN_PLACE = "Unknown"
COORD_PREFIX = "coord_"

# --- fixed values: windows ------------------------------------------------------------
SLIDING_WINDOW = "5 minutes"
SLIDING_STEP = "1 minute"
TUMBLING_WINDOW = "1 minute"

# --- fixed values: history ------------------------------------------------------------
HISTORY_YEARS = 10
DAYS_PER_YEAR = 365
HISTORY_FILE = "weather_history_raw.json"

# --- fixed values: topics -------------------------------------------------------------
TOPIC_REQUESTED = "weather_requested"
TOPIC_READINGS = "weather_stream"
TOPIC_CURRENT = "weather_current"
TOPIC_TRANSFORMED = "weather_transformed"
TOPIC_AGGREGATES = "weather_aggregates"
TOPIC_HISTORY = "weather_history"
TOPIC_RECORDS = "weather_records"

# --- fixed values: text formats -------------------------------------------------------
RIDE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TRUE_WORDS = ("true", "1")
