"""Column layouts of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column of each 15-minute measure and its short name.
READING_MEASURES = {
    "electricity_kwh": "out.electricity.total.energy_consumption",
    "net_electricity_kwh": "out.electricity.net.energy_consumption",
    "cooling_kwh": "out.electricity.cooling.energy_consumption",
    "cooling_fans_pumps_kwh": "out.electricity.cooling_fans_pumps.energy_consumption",
    "heating_kwh": "out.electricity.heating.energy_consumption",
    "heating_backup_kwh": "out.electricity.heating_hp_bkup.energy_consumption",
    "heating_fans_pumps_kwh": "out.electricity.heating_fans_pumps.energy_consumption",
    "hot_water_kwh": "out.electricity.hot_water.energy_consumption",
}

# Source column of each building attribute, its name and type.
BUILDING_ATTRIBUTES = {
    "building_id": ("bldg_id", "bigint"),
    "state": ("in.state", "string"),
    "county_code": ("in.county", "string"),
    "building_type": ("in.geometry_building_type_recs", "string"),
    "floor_area_sqft": ("in.sqft", "double"),
    "construction_vintage": ("in.vintage", "string"),
    "heating_fuel": ("in.heating_fuel", "string"),
    "heating_system": ("in.hvac_heating_type", "string"),
    "cooling_system": ("in.hvac_cooling_type", "string"),
    "reference_annual_electricity_kwh": (
        "out.electricity.total.energy_consumption.kwh",
        "double",
    ),
}

WEATHER_MEASURES = [
    "relative_humidity_pct",
    "wind_speed_mps",
    "wind_direction_deg",
    "global_horizontal_radiation_wm2",
    "direct_normal_radiation_wm2",
    "diffuse_horizontal_radiation_wm2",
]

# Attributes that ride along with a building through the aggregates.
PLACE = ["state", "county_code", "weather_city"]
END_USES = ["cooling_system_kwh", "heating_system_kwh", "hot_water_kwh"]


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _fields(spec: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in spec.items()])


def readings_schema(extra: dict[str, str] | None = None) -> T.StructType:
    """Landing files of interval readings; ``extra`` names columns added later."""
    spec = {"bldg_id": "bigint", "timestamp": "timestamp_ntz"}
    spec.update({source: "double" for source in READING_MEASURES.values()})
    spec.update(extra or {})
    return _fields({**spec, "ingest_date": "date"})


_ACCOUNT_KEYS = {"building_id": "bigint", "account_id": "string"}
_PLACE = {name: "string" for name in PLACE}

ACCOUNTS = _fields(
    {
        **_ACCOUNT_KEYS,
        "state": "string",
        "county_code": "string",
        "building_type": "string",
        "floor_area_sqft": "double",
        "construction_vintage": "string",
        "heating_fuel": "string",
        "heating_system": "string",
        "cooling_system": "string",
        "days_present": "bigint",
        "annual_electricity_kwh": "double",
        "average_daily_kwh": "double",
        "peak_15min_average_kw": "double",
        "data_description": "string",
        "weather_city": "string",
        "reference_annual_electricity_kwh": "double",
    }
)

_USE = {
    "electricity_kwh": "double",
    "net_electricity_kwh": "double",
    **{name: "double" for name in END_USES},
    "peak_15min_average_kw": "double",
}
_CLIMATE = {
    name: "double"
    for name in [
        "average_temperature_f",
        "minimum_temperature_f",
        "maximum_temperature_f",
        "cooling_degree_days_65",
        "heating_degree_days_65",
        "average_relative_humidity_pct",
        "average_wind_speed_mps",
    ]
}

DAILY = _fields(
    {
        **_ACCOUNT_KEYS,
        **_PLACE,
        "usage_date": "date",
        "hours_present": "bigint",
        **_USE,
        **_CLIMATE,
    }
)

MONTHLY = _fields(
    {
        **_ACCOUNT_KEYS,
        **_PLACE,
        "usage_month": "timestamp_ntz",
        "days_present": "bigint",
        "average_daily_kwh": "double",
        **_USE,
        **_CLIMATE,
    }
)

# Measures of a month that are also shown for the month before it.
LAGGED = [
    "electricity_kwh",
    "average_daily_kwh",
    *END_USES,
    "average_temperature_f",
    "cooling_degree_days_65",
    "heating_degree_days_65",
]

# Name of each month-over-month difference and its measure.
CHANGES = {
    "electricity_change_kwh": "electricity_kwh",
    "cooling_change_kwh": "cooling_system_kwh",
    "heating_change_kwh": "heating_system_kwh",
    "hot_water_change_kwh": "hot_water_kwh",
    "average_temperature_change_f": "average_temperature_f",
    "cooling_degree_days_change_65": "cooling_degree_days_65",
    "heating_degree_days_change_65": "heating_degree_days_65",
}

# Month measures published next to their predecessors, in the published order.
COMPARED = [
    "electricity_kwh",
    "average_daily_kwh",
    *END_USES,
    "average_temperature_f",
    "minimum_temperature_f",
    "maximum_temperature_f",
    "cooling_degree_days_65",
    "heating_degree_days_65",
]
DERIVED = [
    "electricity_change_kwh",
    "daily_usage_change_pct",
    "cooling_change_kwh",
    "heating_change_kwh",
    "hot_water_change_kwh",
    "other_electricity_change_kwh",
    "cooling_share_of_net_change_pct",
    "average_temperature_change_f",
    "cooling_degree_days_change_65",
    "heating_degree_days_change_65",
]
INVESTIGATION_COLUMNS = [
    "building_id",
    *PLACE,
    "usage_month",
    *COMPARED,
    "previous_month",
    *[f"previous_{name}" for name in LAGGED],
    *DERIVED,
]

INVESTIGATIONS = _fields(
    {
        "account_id": "string",
        **{
            name: {
                "building_id": "bigint",
                "usage_month": "timestamp_ntz",
                "previous_month": "timestamp_ntz",
            }.get(name, "string" if name in PLACE else "double")
            for name in INVESTIGATION_COLUMNS
        },
    }
)

METADATA = _fields(
    {
        "snapshot_id": "string",
        "schema_version": "int",
        "created_at_utc": "string",
        "dataset": "string",
        "data_type": "string",
        "weather_alignment_verified": "boolean",
        "weather_alignment_method": "string",
        "degree_day_base_f": "double",
    }
)

TRANSFER_RECORD = _fields(
    {
        "run_timestamp_utc": "string",
        "run_date": "date",
        "status": "string",
        "message": "string",
        "filename": "string",
        "source_key": "string",
        "landing_key": "string",
        "archive_key": "string",
        "source_size_bytes": "bigint",
        "landing_size_bytes": "bigint",
        "archive_size_bytes": "bigint",
        "source_etag": "string",
        "landing_etag": "string",
        "archive_etag": "string",
        "landing_reused": "boolean",
        "archive_reused": "boolean",
        "files_waiting_before_run": "bigint",
        "files_found": "bigint",
        "files_transferred": "bigint",
        "source_removed_from_incoming": "boolean",
        "error_type": "string",
    }
)
