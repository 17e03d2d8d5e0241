"""Declared schemas of every message and file; all fields are nullable.

Field names, types and order are fixed values shared with the other producers and consumers.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructType

CORRUPT_COLUMN = "_corrupt_record"


def struct(fields: str, **types: DataType) -> StructType:
    """Schema from ``"name type, ..."``; a type is a JSON type name or a keyword of this call."""
    schema = StructType()
    for field in fields.split(","):
        name, kind = field.split()
        schema = schema.add(name, types.get(kind, kind))
    return schema


def joined(*parts: StructType) -> StructType:
    return StructType([field for part in parts for field in part.fields])


def with_corrupt_column(schema: StructType, name: str = CORRUPT_COLUMN) -> StructType:
    """The same schema plus the column that receives undecodable text."""
    return StructType(list(schema.fields)).add(name, "string")


GEO = struct("city string, country string, country_code string, region string, population long")

# weathercode is decoded as a double and narrowed afterwards: some producers send 3.0,
# which a JSON int field would turn into NULL.
CURRENT = struct(
    "time string, temperature_2m double, windspeed_10m double, weathercode double, "
    "relative_humidity_2m double, apparent_temperature double"
)

# Nested reading as published by the pollers.
READING = struct(
    "latitude double, longitude double, timezone string, elevation double, current measures, "
    "timestamp string, fetched_at string",
    measures=CURRENT,
)

# Nested reading that also carries its resolved place.
ENRICHED_READING = joined(GEO, READING)

# Flat raw reading; coordinates arrive as text.
FLAT_READING = struct(
    "latitude string, longitude string, temperature double, windspeed double, "
    "winddirection double, time string"
)

# Flat reading after the Fahrenheit / high-wind step.
FLAT_TRANSFORMED = struct(
    "temperature double, windspeed double, temp_f double, high_wind_alert boolean, time string"
)

# Reading that still names the place asked for.
REQUESTED_READING = joined(struct("requested_city string, requested_country string"), READING)

# Classified reading, 15 columns.
TRANSFORMED = struct(
    "latitude double, longitude double, timezone string, elevation double, event_time string, "
    "temperature double, windspeed double, weathercode integer, humidity double, "
    "apparent_temperature double, timestamp string, fetched_at string, "
    "wind_alert_level string, heat_alert_level string, processing_time string"
)

# Classified reading with its place.
TRANSFORMED_GEO = joined(TRANSFORMED, GEO)

# Daily series inside a history document: parallel arrays driven by ``time``.
DAILY_SERIES = struct(
    "time texts, temperature_2m_max numbers, temperature_2m_min numbers, temperature_2m_mean numbers, "
    "windspeed_10m_max numbers, windspeed_10m_mean numbers, precipitation_sum numbers, "
    "weathercode numbers, sunrise texts, sunset texts",
    texts=ArrayType(StringType()),
    numbers=ArrayType(DoubleType()),
)
HISTORY_DOCUMENT = struct(
    "geocode_info place, historical_data history, downloaded_at string",
    place=struct(
        "city string, country string, country_code string, latitude double, longitude double, admin1 string"
    ),
    history=struct(
        "latitude double, longitude double, elevation double, timezone string, daily series",
        series=DAILY_SERIES,
    ),
)

# One row per city and day.
DAILY = struct(
    "city string, country string, country_code string, latitude double, longitude double, "
    "date date, temp_max double, temp_min double, wind_max double, precipitation double"
)

# Stored alert line; the last columns are the partition folders: place, and the batch that wrote it.
ALERT = struct(
    "country string, city string, latitude double, longitude double, event_time string, "
    "temperature double, windspeed double, wind_alert_level string, heat_alert_level string, "
    "weathercode integer, humidity double, saved_at string"
)
STORED_ALERT = joined(ALERT, struct("country_path string, city_path string, batch string"))

# Geocoder answers: one row per requested place and candidate, in answer order.
CANDIDATE = struct(
    "requested_city string, requested_country string, position integer, name string, "
    "country string, country_code string, admin1 string, timezone string, "
    "latitude double, longitude double, population long"
)

RIDE = struct("id long, timestamp string, sur_velo string, vitesse double")
CLIMATE = struct("station string, date date, temperature double, precipitation double, country string")
