"""Straight-line transects: how many samples, where, and their series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclimate.functions.grid import asked_tiles, grid_value, with_cell
from gridclimate.functions.text import round_half_even
from gridclimate.plans.points import CELL_KEY
from gridclimate.sources.store import select_window

# Kilometres per degree of latitude and of longitude at the equator.
KM_PER_LAT, KM_PER_LON = 111.1, 111.32
DEFAULT_LAT_STEP = 0.5


def line_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat-earth length at the mid latitude."""
    north = (lat2 - lat1) * KM_PER_LAT
    east = (lon2 - lon1) * KM_PER_LON * F.cos(F.radians((lat1 + lat2) / 2))
    return F.hypot(north, east)


def finest_step(params: Column) -> Column:
    """Smallest latitude step among the parameters; the default grid when there are none."""
    steps = F.transform(params, lambda p: grid_value(p, "lat_step"))
    return F.coalesce(F.array_min(steps), F.lit(DEFAULT_LAT_STEP))


def transect_counts(df: DataFrame) -> DataFrame:
    """Add `total_km`, `n_points` and `transect_error`.

    Takes `lat1, lon1, lat2, lon2, num_points, spacing_km, params`. A given
    number beats a given spacing; both are cut so that samples are not closer
    than the finest grid asked for; at least two samples remain.
    """
    km, step_km = F.col("total_km"), F.col("_step_km")
    from_spacing = F.greatest(F.lit(2.0), F.rint(km / F.col("spacing_km")) + 1)
    asked = F.when(F.col("num_points").isNotNull(), F.col("num_points").cast("double")).when(F.col("spacing_km") > 0, from_spacing)
    room = F.greatest(F.lit(2.0), F.floor(km / step_km).cast("double") + 1)
    too_dense = (F.col("_asked") > 1) & (km / F.nullif(F.col("_asked") - 1, F.lit(0.0)) < step_km)
    error = (F.when(F.col("num_points").isNull() & F.col("spacing_km").isNull(), F.lit("no point count and no spacing"))
             .when(F.col("num_points").isNull() & (F.col("spacing_km") <= 0), F.lit("spacing not positive")))
    sized = (df.withColumn("total_km", line_km(*map(F.col, ("lat1", "lon1", "lat2", "lon2"))))
             .withColumns({"_step_km": finest_step(F.col("params")) * KM_PER_LAT, "_asked": asked}))
    return (sized.withColumns({
                "n_points": F.greatest(F.lit(2.0), F.when(too_dense, room).otherwise(F.col("_asked"))).cast("int"),
                "transect_error": error})
            .withColumn("n_points", F.when(F.col("transect_error").isNull(), F.col("n_points")))
            .drop("_step_km", "_asked"))


def transect_points(counted: DataFrame, key: str = "transect_id") -> DataFrame:
    """One row per sample: `key, point_no, lat, lon, name, params`, ends included, four decimals."""
    i, n = F.col("_i"), F.col("n_points")

    def along(first: str, last: str) -> Column:
        step = (F.col(last) - F.col(first)) / (n - 1)
        return round_half_even(F.when(i == n - 1, F.col(last)).otherwise(i * step + F.col(first)), 4)

    return (counted.where("n_points is not null")
            .withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
            .select(key, (i + 1).alias("point_no"), along("lat1", "lat2").alias("lat"),
                    along("lon1", "lon2").alias("lon"),
                    F.concat(F.lit("Point_"), (i + 1).cast("string")).alias("name"), "params"))


def transect_cells(transects: DataFrame, key: str = "transect_id", params: list[str] | None = None) -> DataFrame:
    """One row per sample and parameter, with its cell; `params` leaves out all others."""
    samples = (transect_points(transect_counts(transects), key)
               .withColumn("param", F.explode("params")).withColumn("variant", F.lit("base")))
    if params:
        samples = samples.where(F.col("param").isin(list(params)))
    return with_cell(samples).select(key, "point_no", "lat", "lon", "name", *CELL_KEY)


def transect_tiles(transects: DataFrame, key: str = "transect_id", params: list[str] | None = None) -> list[int]:
    """Tiles of the store that the transects cross."""
    return asked_tiles(transect_cells(transects, key, params))


def transect_query(store: DataFrame, transects: DataFrame, start: str, end: str,
                   temporal: str = "daily", key: str = "transect_id", params: list[str] | None = None,
                   tiles: list[int] | None = None) -> DataFrame:
    """Series along each transect, long: `key, point_no, lat, lon, name, param, obs_ts, value`.

    Each transect may ask for its own parameters; `params` names all that are asked
    for and `tiles` the tiles they cross, so the scan prunes by them. One equi-join, whose
    history side is read and, if at all, shuffled once.
    """
    cells = transect_cells(transects, key, params)
    window = select_window(store, temporal, params, start, end, tiles=tiles).select(*CELL_KEY, "obs_ts", "value")
    return cells.join(window, CELL_KEY).select(key, "point_no", "lat", "lon", "name", "param", "obs_ts", "value")


def silent_transects(transects: DataFrame, answered: DataFrame, key: str = "transect_id") -> DataFrame:
    """Transects without a single observation, the case the caller treats as an error."""
    return transects.join(answered.select(key), key, "left_anti")

