"""Containing grid cell of a coordinate, per parameter.

The parameter decides the grid, and only two grids exist, so the choice is a
literal CASE inside the projection: no join, no shuffle, full code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclimate.sources.catalog import METEO_GRID, SOLAR, SOLAR_GRID

#: Side of a storage tile. It is part of the layout of every store, so it must not change under one.
TILE_DEGREES = 90
TILE_ROWS, TILE_COLUMNS = 180 // TILE_DEGREES, 360 // TILE_DEGREES


def grid_value(param: Column, key: str) -> Column:
    """One grid attribute (`lat_step`, `lon_step`, `anchor`, `n_lat`, `n_lon`) by parameter."""
    return F.when(param.isin(SOLAR), F.lit(SOLAR_GRID[key])).otherwise(F.lit(METEO_GRID[key]))


def cell_lat_index(lat: Column, param: Column) -> Column:
    """Row of the cell holding `lat`; the pole belongs to the last row."""
    raw = F.floor((lat + 90.0) / grid_value(param, "lat_step") + grid_value(param, "anchor"))
    # `least` alone would skip a NULL latitude and name the pole
    return F.when(raw.isNotNull(), F.least(raw, grid_value(param, "n_lat").cast("bigint") - 1)).cast("int")


def cell_lon_index(lon: Column, param: Column) -> Column:
    """Column of the cell holding `lon`; longitudes wrap around."""
    raw = F.floor((lon + 180.0) / grid_value(param, "lon_step") + grid_value(param, "anchor"))
    return F.pmod(raw, grid_value(param, "n_lon").cast("bigint")).cast("int")


def cell_centre_lat(index: Column, param: Column) -> Column:
    return (index + 0.5 - grid_value(param, "anchor")) * grid_value(param, "lat_step") - 90.0


def cell_centre_lon(index: Column, param: Column) -> Column:
    return (index + 0.5 - grid_value(param, "anchor")) * grid_value(param, "lon_step") - 180.0


def tile_of(cell_lat: Column, cell_lon: Column, param: Column) -> Column:
    """Storage tile of a cell, the same on both grids; at most `TILE_ROWS * TILE_COLUMNS` exist."""
    def part(index: Column, step: str, most: int) -> Column:
        return F.least(F.floor(index * grid_value(param, step) / TILE_DEGREES), F.lit(most - 1).cast("bigint"))
    row, column = part(cell_lat, "lat_step", TILE_ROWS), part(cell_lon, "lon_step", TILE_COLUMNS)
    # `least` alone would skip a NULL index and name the last tile
    return F.when(cell_lat.isNotNull() & cell_lon.isNotNull(), row * TILE_COLUMNS + column).cast("int")


def asked_tiles(cells: DataFrame) -> list[int]:
    """Tiles that hold some of the cells (`param, cell_lat, cell_lon`): a job over the cells, a few numbers back.

    Stated as literals they cut the store's partitions whatever join is chosen later.
    """
    tiles = cells.select(tile_of(F.col("cell_lat"), F.col("cell_lon"), F.col("param")).alias("tile")).distinct()
    return sorted(r["tile"] for r in tiles.where("tile is not null").collect())


def with_cell(df: DataFrame, lat: str = "lat", lon: str = "lon", param: str = "param") -> DataFrame:
    """Add `cell_lat` and `cell_lon`."""
    return df.withColumns({
        "cell_lat": cell_lat_index(F.col(lat), F.col(param)),
        "cell_lon": cell_lon_index(F.col(lon), F.col(param)),
    })


def variant_of(elevation: Column, wind_elevation: Column, wind_surface: Column) -> Column:
    """Key part for site options that change the served values; `base` when none is given."""
    text = F.concat_ws(
        ";",
        F.concat(F.lit("elev="), elevation.cast("string")),
        F.concat(F.lit("wind_elev="), wind_elevation.cast("string")),
        F.concat(F.lit("wind_surf="), wind_surface.cast("string")),
    )
    return F.when(F.length(text) == 0, F.lit("base")).otherwise(text)
