"""Column lists and types of the flight data, for typed reading."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delaywright.operators.cleaning import cast_columns, cast_dates, keep_known

# Types of the raw joined flight and weather file, which is read as text.
RAW_INTEGERS = (
    "QUARTER",
    "DAY_OF_MONTH",
    "DAY_OF_WEEK",
    "OP_CARRIER_AIRLINE_ID",
    "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID",
    "ORIGIN_AIRPORT_SEQ_ID",
    "ORIGIN_CITY_MARKET_ID",
    "ORIGIN_STATE_FIPS",
    "ORIGIN_WAC",
    "DEST_AIRPORT_ID",
    "DEST_AIRPORT_SEQ_ID",
    "DEST_CITY_MARKET_ID",
    "DEST_STATE_FIPS",
    "DEST_WAC",
    "CRS_DEP_TIME",
    "DEP_TIME",
    "DEP_DELAY",
    "TAXI_OUT",
    "WHEELS_OFF",
    "WHEELS_ON",
    "TAXI_IN",
    "CRS_ARR_TIME",
    "ARR_TIME",
    "ARR_DELAY",
    "CANCELLED",
    "DIVERTED",
    "CRS_ELAPSED_TIME",
    "ACTUAL_ELAPSED_TIME",
    "AIR_TIME",
    "DISTANCE",
)
RAW_FLOATS = (
    "LATITUDE",
    "LONGITUDE",
    "ELEVATION",
)
RAW_DOUBLES = (
    "MONTH",
    "YEAR",
    "HourlyDewPointTemperature",
    "HourlyDryBulbTemperature",
    "HourlyPrecipitation",
    "HourlyRelativeHumidity",
    "HourlySkyConditions",
    "HourlySeaLevelPressure",
    "HourlyStationPressure",
    "HourlyVisibility",
    "HourlyWetBulbTemperature",
    "HourlyWindSpeed",
    "HourlyAltimeterSetting",
    "DEP_DEL15",
)

# What is known two hours before departure, and the target.
KNOWN_TWO_HOURS_BEFORE = (
    "QUARTER",
    "MONTH",
    "DAY_OF_MONTH",
    "DAY_OF_WEEK",
    "FL_DATE",
    "OP_UNIQUE_CARRIER",
    "OP_CARRIER_AIRLINE_ID",
    "OP_CARRIER",
    "TAIL_NUM",
    "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID",
    "ORIGIN_CITY_MARKET_ID",
    "ORIGIN",
    "ORIGIN_CITY_NAME",
    "ORIGIN_STATE_ABR",
    "ORIGIN_STATE_FIPS",
    "ORIGIN_STATE_NM",
    "ORIGIN_WAC",
    "DEST_AIRPORT_ID",
    "DEST_CITY_MARKET_ID",
    "DEST",
    "DEST_CITY_NAME",
    "DEST_STATE_ABR",
    "DEST_STATE_FIPS",
    "DEST_STATE_NM",
    "DEST_WAC",
    "DISTANCE",
    "YEAR",
    "STATION",
    "DATE",
    "LATITUDE",
    "LONGITUDE",
    "ELEVATION",
    "NAME",
    "HourlyAltimeterSetting",
    "HourlyDewPointTemperature",
    "HourlyDryBulbTemperature",
    "HourlyPrecipitation",
    "HourlyPresentWeatherType",
    "HourlyPressureChange",
    "HourlyPressureTendency",
    "HourlyRelativeHumidity",
    "HourlySkyConditions",
    "HourlySeaLevelPressure",
    "HourlyStationPressure",
    "HourlyVisibility",
    "HourlyWetBulbTemperature",
    "HourlyWindDirection",
    "HourlyWindGustSpeed",
    "HourlyWindSpeed",
    "Sunrise",
    "Sunset",
    "DEP_DELAY",
    "DEP_DEL15",
)

# Types of the feature table.
FEATURE_TYPES = {
    "OP_UNIQUE_CARRIER": "string",
    "ORIGIN_AIRPORT_ID": "int",
    "DEST_AIRPORT_ID": "int",
    "ELEVATION": "double",
    "HourlyAltimeterSetting": "double",
    "HourlyDryBulbTemperature": "double",
    "HourlyPrecipitation": "double",
    "HourlyPresentWeatherType": "string",
    "HourlyRelativeHumidity": "double",
    "HourlySkyConditions": "string",
    "HourlySeaLevelPressure": "double",
    "HourlyVisibility": "double",
    "HourlyWindDirection": "double",
    "HourlyWindSpeed": "double",
    "crs_dep_hour_sin": "double",
    "crs_dep_hour_cos": "double",
    "crs_dep_day_of_year_sin": "double",
    "crs_dep_day_of_year_cos": "double",
    "crs_dep_time_part_of_day": "string",
    "DISTANCE": "double",
    "tail_num_flight_seq_num": "int",
    "parallel_flights": "bigint",
    "prior_flight_dep_delay_new": "float",
    "christmas_travel": "int",
    "federal_holiday_indicator": "int",
    "FL_DATE": "date",
}


def _present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [c for c in names if c in df.columns]


def type_raw_flights(df: DataFrame) -> DataFrame:
    """Narrow the text columns of the raw file that exist; unreadable values become null."""
    types = {c: "int" for c in _present(df, RAW_INTEGERS)}
    types |= {c: "float" for c in _present(df, RAW_FLOATS)}
    types |= {c: "double" for c in _present(df, RAW_DOUBLES)}
    typed = cast_columns(df, types)
    return cast_dates(typed, ["FL_DATE"]) if "FL_DATE" in df.columns else typed


def known_before_departure(df: DataFrame) -> DataFrame:
    return keep_known(df, KNOWN_TWO_HOURS_BEFORE)


def type_feature_table(df: DataFrame) -> DataFrame:
    return cast_columns(df, {c: t for c, t in FEATURE_TYPES.items() if c in df.columns})
