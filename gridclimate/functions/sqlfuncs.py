"""Temporary SQL functions, so SQL users get the same expressions.

Each is a plain `RETURN expression`; the optimizer inlines it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridclimate.functions import coordinates as C
from gridclimate.sources.catalog import METEO_GRID, SOLAR, SOLAR_GRID


def _grid(param: str, key: str) -> str:
    codes = ", ".join(f"'{c}'" for c in SOLAR)
    return f"(case when {param} in ({codes}) then {SOLAR_GRID[key]} else {METEO_GRID[key]} end)"


def _real(param: str, key: str) -> str:
    return f"cast({_grid(param, key)} as double)"


def definitions() -> dict[str, str]:
    """Function name to the rest of its `CREATE TEMPORARY FUNCTION` statement."""
    coord = "(t STRING, is_lat BOOLEAN) RETURNS DOUBLE RETURN "
    shown = "(v DOUBLE, is_lat BOOLEAN) RETURNS STRING RETURN "
    lat_index = f"floor((lat + 90e0) / {_real('param', 'lat_step')} + {_real('param', 'anchor')})"
    lon_index = f"floor((lon + 180e0) / {_real('param', 'lon_step')} + {_real('param', 'anchor')})"
    return {
        "gc_clean_coord": "(t STRING) RETURNS STRING RETURN " + C.clean_sql("t"),
        "gc_parse_dd": coord + C.parse_sql("t", "is_lat", ("dd",)),
        "gc_parse_ddm": coord + C.parse_sql("t", "is_lat", ("ddm",)),
        "gc_parse_dms": coord + C.parse_sql("t", "is_lat", ("dms",)),
        "gc_parse_coord": coord + C.parse_sql("t", "is_lat"),
        "gc_format_dd": shown + C.format_dd_sql("v", "is_lat"),
        "gc_format_ddm": shown + C.format_ddm_sql("v", "is_lat"),
        "gc_format_dms": shown + C.format_dms_sql("v", "is_lat"),
        "gc_cell_lat": "(lat DOUBLE, param STRING) RETURNS INT RETURN "
                       f"cast(if(lat is null, null, least({lat_index}, {_grid('param', 'n_lat')} - 1)) as int)",
        "gc_cell_lon": "(lon DOUBLE, param STRING) RETURNS INT RETURN "
                       f"cast(pmod({lon_index}, {_grid('param', 'n_lon')}) as int)",
        "gc_gdd": "(t2m DOUBLE, base DOUBLE) RETURNS DOUBLE RETURN "
                  "case when t2m is not null then greatest(t2m - base, 0e0) end",
    }


def register(spark: SparkSession) -> list[str]:
    """Create every function in the session; returns their names."""
    for name, rest in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{rest}")
    return list(definitions())
