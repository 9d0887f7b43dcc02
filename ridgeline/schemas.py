"""Declared schemas and fixed value tables of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Expected columns of the hourly weather table, in stored order.
HOURLY_COLUMNS = [
    "time", "valid_time", "fxx", "t", "prate", "sde", "tp",
    "sdswrf", "suswrf", "sdlwrf", "sulwrf", "point_id",
    "t2m", "r2", "si10", "wdir10", "max_10si",
]
HOURLY_KEYS = ["time", "valid_time", "fxx", "point_id"]

# Hourly weather column -> station file field, in written order.
STATION_FIELDS = {
    "time": "timestamp",
    "t": "TSG",
    "t2m": "TA",
    "r2": "RH",
    "si10": "VW",
    "max_10si": "VW_MAX",
    "wdir10": "DW",
    "sdswrf": "ISWR",
    "suswrf": "RSWR",
    "sdlwrf": "ILWR",
    "sulwrf": "OLWR",
    "prate": "PINT",
    "tp": "PSUM",
    "sde": "HS",
}

# Patterns that choose parameters of the gridded source by their long name.
SURFACE_PATTERN = r":(?:TMP|SNOD|PRATE|APCP|.*WRF|RH|ASNOW):surface"
TWO_METRE_PATTERN = r":(?:TMP|RH):2 m"
WIND_PATTERN = r":WIND|GRD:10 m above"
VARIABLE_PATTERNS = [SURFACE_PATTERN, TWO_METRE_PATTERN, WIND_PATTERN]

# Zone spellings -> published zone name.
ZONE_ALIASES = {
    "whitefish range": "Whitefish",
    "swan range": "Swan",
    "flathead range & glacier np": "Glacier/Flathead",
    "whitefish": "Whitefish",
    "swan": "Swan",
    "flathead": "Glacier/Flathead",
    "glacier/flathead": "Glacier/Flathead",
}

# Elevation bands, lowest first, and the ordinal danger levels.
BANDS = ["lower", "middle", "upper"]
FEET_PER_METRE = 3.281
BAND_EDGES_FEET = [0.0, 5000.0, 6500.0, 13000.0]
LEVEL_NAMES = {-1: "Unknown", 1: "Low", 2: "Moderate", 3: "Considerable", 4: "High"}
LEVEL_CODES = {-1: "unknown", 1: "low", 2: "mod", 3: "con", 4: "hig"}
LEVEL_COLOURS = {0: "green", 1: "yellow", 2: "orange", 3: "red"}

# Missing-value sentinel, local time zone, local hour at which a day starts,
# and the months with no snow season.
SENTINEL = -999.0
LOCAL_ZONE = "America/Denver"
DAY_START_HOUR = 19
SUMMER_MONTHS = (6, 7, 8, 9)
SEASON_FIRST_MONTH = 10

# Daily weather report: output column -> (source column, aggregate).
DAILY_WEATHER = {
    "temp_avg": ("TA", "avg"),
    "rh_avg": ("RH", "avg"),
    "wind_avg": ("VW", "avg"),
    "wind_transport24": ("wind_trans24", "avg"),
    "new_snow_24": ("HN24", "avg"),
    "new_snow_12": ("HN12", "avg"),
    "new_snow_72_24": ("HN72_24", "avg"),
    "precip_total": ("PSUM24", "avg"),
    "snow_depth_avg": ("HS_mod", "avg"),
    "swe_avg": ("SWE", "avg"),
    "ski_pen_avg": ("ski_pen", "avg"),
    "hoar_size_max": ("hoar_size", "max"),
    "cold_content": ("ColdContentSnow", "avg"),
    "liquid_water": ("MS_Water", "avg"),
    "rain_mass": ("MS_Rain", "avg"),
    "solar_in": ("ISWR", "sum"),
    "danger_level": ("predicted_danger", "max"),
}
# Units in which report columns are shown, where they differ from the source.
REPORT_UNITS = {
    "temp_avg": "fahrenheit", "wind_avg": "mph",
    "new_snow_24": "cm to inches", "new_snow_12": "cm to inches", "new_snow_72_24": "cm to inches",
    "precip_total": "cm to inches", "snow_depth_avg": "cm to inches", "ski_pen_avg": "cm to inches",
    "swe_avg": "mm to inches",
}
# Decimals shown per report column.
REPORT_DECIMALS = {
    "temp_avg": 1, "rh_avg": 0, "wind_avg": 1, "wind_transport24": 2,
    "new_snow_24": 1, "new_snow_12": 1, "new_snow_72_24": 1, "precip_total": 2,
    "snow_depth_avg": 1, "swe_avg": 2, "ski_pen_avg": 1, "hoar_size_max": 2,
    "cold_content": 0, "liquid_water": 2, "rain_mass": 2, "solar_in": 0,
}
# Columns never used as a model input.
NOT_FEATURES = ["danger_rating", "lower", "upper", "middle", "id_y"]
DROPPED_PROFILE_COLUMNS = ["MS_Soil_Runoff", "TSS_meas"]
PROFILE_KEYS = ["id", "slope_angle", "slope_azi"]
# --- end of fixed values ----------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_KEY_TYPES = {
    "time": T.TimestampNTZType(),
    "valid_time": T.TimestampNTZType(),
    "fxx": T.IntegerType(),
    "point_id": T.LongType(),
}
HOURLY = _struct(**{c: _KEY_TYPES.get(c, T.DoubleType()) for c in HOURLY_COLUMNS})

PROFILE_MEASURES = [source for source, _ in DAILY_WEATHER.values() if source != "predicted_danger"]
PROFILE = _struct(
    id=T.LongType(), slope_angle=T.DoubleType(), slope_azi=T.DoubleType(),
    altitude=T.DoubleType(), timestamp=T.TimestampNTZType(),
    **{c: T.DoubleType() for c in PROFILE_MEASURES},
)

POINTS = _struct(id=T.LongType(), lat=T.DoubleType(), lon=T.DoubleType(), zone_name=T.StringType())

ZONE_DAY = _struct(
    date=T.DateType(), zone_name=T.StringType(), elevation_band=T.StringType(),
    slope_angle=T.StringType(), predicted_danger=T.IntegerType(),
)
OBSERVED_WIDE = _struct(
    zone_name=T.StringType(), date=T.DateType(),
    upper=T.IntegerType(), middle=T.IntegerType(), lower=T.IntegerType(),
)
OBSERVED_LONG = _struct(
    date=T.DateType(), zone_name=T.StringType(), elevation_band=T.StringType(),
    actual_danger=T.IntegerType(), slope_angle=T.StringType(),
)
CELLS = _struct(iy=T.IntegerType(), ix=T.IntegerType(), lat=T.DoubleType(), lon=T.DoubleType())
PIXELS = _struct(file=T.StringType(), x=T.DoubleType(), y=T.DoubleType(), elevation_m=T.DoubleType())
ELEVATION_CACHE = _struct(id=T.LongType(), elevation=T.DoubleType(), file=T.StringType())
ELEVATION_CACHE_JSON = T.MapType(
    T.StringType(), _struct(elevation=T.DoubleType(), tif_file=T.StringType())
)

DISCUSSION_JSON = _struct(
    date=T.StringType(),
    forecasts=T.ArrayType(
        _struct(
            zone=T.StringType(), primary_concern=T.StringType(),
            discussion=T.StringType(), travel_advice=T.StringType(),
        )
    ),
)
REPORT_JSON = _struct(
    meta=_struct(latest_day=T.LongType()),
    predictions=T.ArrayType(
        _struct(
            date=T.LongType(), zone=T.StringType(),
            elevation=T.StringType(), predicted_danger=T.IntegerType(),
        )
    ),
    dangers=T.ArrayType(
        _struct(
            date=T.LongType(), zone=T.StringType(),
            elevation=T.StringType(), actual_danger=T.IntegerType(),
        )
    ),
)
WEATHER_JSON = _struct(
    date=T.LongType(),
    weather=T.ArrayType(
        _struct(
            zone_name=T.StringType(), elevation_band=T.StringType(),
            slope_angle=T.DoubleType(), slope_azi=T.DoubleType(),
            **{c: T.DoubleType() for c in DAILY_WEATHER if c != "danger_level"},
            danger_level=T.IntegerType(), date_epoch=T.LongType(),
        )
    ),
)
METRICS_JSON = _struct(
    accuracy=T.DoubleType(), balanced_accuracy=T.DoubleType(), mae=T.DoubleType()
)
REQUEST_LOG = _struct(
    logged=T.StringType(), start=T.StringType(), end=T.StringType(), message=T.StringType()
)
