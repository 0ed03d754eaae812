"""Parameter catalogue: a fixed dimension table, safe to broadcast.

The catalogue has 18 rows and does not grow with the data, so it is either
broadcast or folded into the plan as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: parameter codes, labels, units and product families --------
# (code, label, short name, description, daily unit, hourly unit)
PARAMETERS = [
    ("T2M", "Temperature at 2 m (°C)", "Temperature at 2 Meters",
     "Average Air Temperature at 2 m", "°C", "°C"),
    ("T2M_MAX", "Maximum Temperature at 2 m (°C)", "Maximum Temperature at 2 Meters",
     "Maximum Air Temperature at 2 m", "°C", "°C"),
    ("T2M_MIN", "Minimum Temperature at 2 m (°C)", "Minimum Temperature at 2 Meters",
     "Minimum Air Temperature at 2 m", "°C", "°C"),
    ("T2M_RANGE", "Temperature Range at 2 m (°C)", "Temperature Range at 2 Meters",
     "Diurnal Temperature Range at 2 m", "°C", "°C"),
    ("T2MWET", "Wet Bulb Temperature at 2 m (°C)", "Wet Bulb Temperature at 2 Meters",
     "Wet Bulb Temperature at 2 m", "°C", "°C"),
    ("T2MDEW", "Dew Point Temperature at 2 m (°C)", "Dew Point Temperature at 2 Meters",
     "Dew Point Temperature at 2 m", "°C", "°C"),
    ("TS", "Surface Skin Temperature (°C)", "Surface Skin Temperature",
     "Surface Skin Temperature", "°C", "°C"),
    ("RH2M", "Relative Humidity at 2 m (%)", "Relative Humidity at 2 Meters",
     "Relative Humidity at 2 m", "%", "%"),
    ("PRECTOTCORR", "Corrected Total Precipitation (mm/day)", "Corrected Total Precipitation",
     "Corrected Total Precipitation (liquid + ice)", "mm/day", "mm/hr"),
    ("ALLSKY_SFC_SW_DWN", "All Sky Surface Shortwave Downward Radiation (kWh/m²/day)",
     "All Sky Surface Shortwave Downward Irradiance",
     "All Sky Surface Shortwave Downward Radiation", "kWh/m²/day", "W/m²"),
    ("ALLSKY_SFC_PAR_TOT", "All Sky Photosynthetically Active Radiation (MJ/m²/day)",
     "All Sky Surface PAR Total",
     "All Sky Photosynthetically Active Radiation", "MJ/m²/day", "W/m²"),
    ("WS10M", "Wind Speed at 10 m (m/s)", "Wind Speed at 10 Meters",
     "Average Wind Speed at 10 m", "m/s", "m/s"),
    ("WS10M_MAX", "Maximum Wind Speed at 10 m (m/s)", "Maximum Wind Speed at 10 Meters",
     "Maximum Wind Speed at 10 m", "m/s", "m/s"),
    ("WD10M", "Wind Direction at 10 m (degrees)", "Wind Direction at 10 Meters",
     "Average Wind Direction at 10 m", "degrees", "degrees"),
    ("PS", "Surface Pressure (kPa)", "Surface Pressure",
     "Surface Pressure", "kPa", "kPa"),
    ("GWETTOP", "Surface Soil Wetness (0-1)", "Surface Soil Wetness",
     "Surface Soil Wetness (top layer, 0-1 fraction)", "0-1", None),
    ("GWETROOT", "Root Zone Soil Wetness (0-1)", "Root Zone Soil Wetness",
     "Root Zone Soil Wetness (0-1 fraction)", "0-1", None),
    ("GWETPROF", "Profile Soil Moisture (0-1)", "Profile Soil Moisture",
     "Profile Soil Moisture (full column, 0-1 fraction)", "0-1", None),
]
DEFAULT_GROUP = ["T2M", "T2M_RANGE", "T2MDEW", "RH2M", "PRECTOTCORR", "ALLSKY_SFC_PAR_TOT", "WS10M"]
DAILY_ONLY = ["GWETTOP", "GWETROOT", "GWETPROF"]
SOLAR = ["ALLSKY_SFC_SW_DWN", "ALLSKY_SFC_PAR_TOT"]
# family -> (source name, lat step, lon step, first daily day, attribution)
METEO_FAMILY = ("MERRA-2/GEOS-IT", 0.5, 0.625, "1981-01-01", "NASA POWER / GMAO MERRA-2")
SOLAR_FAMILY = ("CERES SYN1deg / FLASHFlux / SRB", 1.0, 1.0, "1984-01-01", "NASA POWER / LaRC CERES")
HOURLY_START = "2001-01-01"
# Request limits of the upstream service.
MAX_PARAMS_DAILY, MAX_PARAMS_HOURLY, MAX_PARAMS_REGIONAL = 20, 15, 1
MAX_BOX_DEGREES = 4.5
WIND_ELEVATION_RANGE = (10.0, 300.0)
RATE_LIMIT_CALLS, RATE_LIMIT_SECONDS = 30, 60
# --- end of fixed values -------------------------------------------------------

ALL_GROUP = [row[0] for row in PARAMETERS]
GROUPS = {"all": ALL_GROUP, "default": DEFAULT_GROUP}

# Cell anchoring of the two published grids: MERRA-2 has cell centres on
# multiples of the step (361 x 576), CERES on half steps (180 x 360).
METEO_GRID = {"lat_step": 0.5, "lon_step": 0.625, "anchor": 0.5, "n_lat": 361, "n_lon": 576}
SOLAR_GRID = {"lat_step": 1.0, "lon_step": 1.0, "anchor": 0.0, "n_lat": 180, "n_lon": 360}

CATALOG_SCHEMA = T.StructType([
    T.StructField("param", T.StringType(), False),
    T.StructField("label", T.StringType()),
    T.StructField("short_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("units", T.StructType([
        T.StructField("daily", T.StringType()), T.StructField("hourly", T.StringType())])),
    T.StructField("source_family", T.StringType()),
    T.StructField("native_grid", T.StructType([
        T.StructField("lat_step", T.DoubleType()), T.StructField("lon_step", T.DoubleType()),
        T.StructField("anchor", T.DoubleType()),
        T.StructField("n_lat", T.IntegerType()), T.StructField("n_lon", T.IntegerType())])),
    T.StructField("availability", T.StructType([
        T.StructField("daily_start", T.StringType()), T.StructField("hourly_start", T.StringType())])),
    T.StructField("time_standards", T.ArrayType(T.StringType())),
    T.StructField("provisional_tail", T.BooleanType()),
    T.StructField("attribution", T.StringType()),
    T.StructField("in_default", T.BooleanType()),
])


def catalog_rows() -> list[tuple]:
    """The catalogue as plain rows, in catalogue order."""
    rows = []
    for code, label, short, text, daily, hourly in PARAMETERS:
        solar, daily_only = code in SOLAR, code in DAILY_ONLY
        family = SOLAR_FAMILY if solar else METEO_FAMILY
        grid = SOLAR_GRID if solar else METEO_GRID
        rows.append((
            code, label, short, text, (daily, hourly), family[0], tuple(grid.values()),
            (family[3], None if daily_only else HOURLY_START),
            ["LST"] if daily_only else ["LST", "UTC"], True, family[4], code in DEFAULT_GROUP))
    return rows


def catalog(spark: SparkSession) -> DataFrame:
    """Parameter catalogue as a table (18 rows), folded into the plan as literals."""
    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, str):
            return "'" + value.replace("'", "\\'") + "'"
        if isinstance(value, list):
            return "array(" + ", ".join(map(literal, value)) + ")"
        if isinstance(value, tuple):
            return "struct(" + ", ".join(map(literal, value)) + ")"
        return f"{value}e0" if isinstance(value, float) else str(value)

    rows = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in catalog_rows())
    table = spark.sql(f"select * from values {rows}")
    return table.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(table.columns, CATALOG_SCHEMA)])


def catalog_group(spark: SparkSession, group: str = "default", strict: bool = False) -> DataFrame:
    """Catalogue rows of one group; an unknown name means `default`, or an error if strict."""
    if strict and group not in GROUPS:
        raise ValueError(f"unknown parameter group {group!r}; known: {', '.join(GROUPS)}")
    codes = GROUPS.get(group, DEFAULT_GROUP)
    return catalog(spark).where(F.col("param").isin(codes))


def describe_param(spark: SparkSession, code: str) -> DataFrame:
    """Catalogue row of one code, any letter case."""
    if code.upper() not in ALL_GROUP:
        raise ValueError(f"unknown parameter code {code.upper()!r}")
    return catalog(spark).where(F.col("param") == code.upper())


def with_catalog(df: DataFrame, param: str = "param", resolution: str | Column = "daily") -> DataFrame:
    """Add units, source family and native grid; unknown codes get the 0.5 x 0.625 grid.

    `resolution` is 'daily' / 'hourly' or a column holding either.
    """
    cat = F.broadcast(catalog(df.sparkSession)).withColumnRenamed("param", "_code")
    res = F.lit(resolution) if isinstance(resolution, str) else resolution
    grid = F.col("native_grid")
    return (df.join(cat, df[param] == F.col("_code"), "left")
            .withColumn("unit", F.when(res == "hourly", F.col("units.hourly")).otherwise(F.col("units.daily")))
            .withColumn("grid_lat_step", F.coalesce(grid["lat_step"], F.lit(METEO_GRID["lat_step"])))
            .withColumn("grid_lon_step", F.coalesce(grid["lon_step"], F.lit(METEO_GRID["lon_step"])))
            .select(*df.columns, "label", "short_name", "unit", "source_family",
                    "grid_lat_step", "grid_lon_step"))
