"""Point and multi-point questions over the observation store.

A site becomes a grid cell per parameter; the question is then an equi-join of
sites and observations. The join keys hold the parameter, so the store is cut
to the asked parameters, years and window before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclimate.functions.dates import calendar, iso_bound
from gridclimate.functions.grid import asked_tiles, cell_lat_index, cell_lon_index, variant_of, with_cell
from gridclimate.sources.catalog import SOLAR, with_catalog
from gridclimate.sources.store import select_window

CELL_KEY = ["param", "cell_lat", "cell_lon", "variant"]
SITE_COLUMNS = ["site_id", "lat", "lon", "name", "elevation"]


def to_wide(obs: DataFrame, keys: list[str], params: list[str]) -> DataFrame:
    """One column per asked parameter, in request order; absent ones are NULL, others dropped."""
    asked = obs.where(F.col("param").isin(list(params)))
    return asked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("param") == p, F.col("value"))).alias(p) for p in params])


def point_query(store: DataFrame, lat: float, lon: float, start: str, end: str, params: list[str],
                temporal: str = "daily", elevation: float | None = None,
                wind_elevation: float | None = None, wind_surface: str | None = None) -> DataFrame:
    """Wide series of one coordinate: `obs_ts` and one column per parameter.

    The cells are literals, so they reach the scan as pushed filters.
    """
    variant = variant_of(F.lit(elevation).cast("double"), F.lit(wind_elevation).cast("double"),
                         F.lit(wind_surface).cast("string"))
    here = point_rows(store, lat, lon, start, end, params, temporal).where(F.col("variant") == variant)
    return to_wide(here, ["obs_ts"], params)


def point_rows(store: DataFrame, lat: float, lon: float, start: str, end: str, params: list[str],
               temporal: str = "daily", end_of_day: bool = False) -> DataFrame:
    """Store rows of the cells around one coordinate."""
    if not params:
        raise ValueError("no parameters given")
    if not (-90.0 <= lat <= 90.0 and -180.0 <= lon <= 180.0):
        raise ValueError("coordinate out of range")
    return select_window(store, temporal, params, start, end, end_of_day).where(_any_cell(params, lat, lon))


def last_stamp(end: str, temporal: str, end_of_day: bool) -> str:
    """Last stamp of a window as text."""
    text = iso_bound(end)
    return f"{text} 23:00:00" if end_of_day and temporal == "hourly" and len(text) == 10 else text


def _any_cell(params: list[str], lat: float, lon: float) -> Column:
    """Filter on the containing cell, by parameter."""
    match = F.lit(False)
    for p in dict.fromkeys(params):
        match = match | ((F.col("param") == p)
                         & (F.col("cell_lat") == cell_lat_index(F.lit(float(lat)), F.lit(p)))
                         & (F.col("cell_lon") == cell_lon_index(F.lit(float(lon)), F.lit(p))))
    return match


def _site_variant(sites: DataFrame, match_variant: bool) -> Column:
    def option(name: str, kind: str) -> Column:
        return F.col(name) if name in sites.columns else F.lit(None).cast(kind)
    if not match_variant:
        return F.lit("base")
    return variant_of(option("elevation", "double"), option("wind_elevation", "double"), option("wind_surface", "string"))


def site_cells(sites: DataFrame, params: list[str], match_variant: bool = True) -> DataFrame:
    """One row per site and parameter, with its cell and variant."""
    expanded = (sites.withColumn("variant", _site_variant(sites, match_variant))
                .withColumn("param", F.explode(F.array(*[F.lit(p) for p in dict.fromkeys(params)]))))
    return with_cell(expanded)


def site_tiles(sites: DataFrame, params: list[str]) -> list[int]:
    """Tiles of the store that the sites lie in; give them to a plan and the other tiles are never opened."""
    return asked_tiles(site_cells(sites, params, match_variant=False))


def multi_point_long(store: DataFrame, sites: DataFrame, start: str, end: str, params: list[str],
                     temporal: str = "daily", match_variant: bool = True,
                     site_columns: list[str] | None = None, tiles: list[int] | None = None) -> DataFrame:
    """Observations of every site, long: site columns, `param, obs_ts, value`.

    Repeated sites stay repeated. No side is hinted: a small site list is
    broadcast by its measured size, a large one is shuffled on the cell key and
    adaptive execution splits cells that many sites share.
    """
    carried = site_columns or [c for c in SITE_COLUMNS if c in sites.columns]
    cells = site_cells(sites, params, match_variant).select(*carried, *CELL_KEY)
    window = select_window(store, temporal, params, start, end, tiles=tiles).select(*CELL_KEY, "obs_ts", "value")
    return cells.join(window, CELL_KEY).select(*carried, "param", "obs_ts", "value")


def with_spot(sites: DataFrame, params: list[str], match_variant: bool = True) -> tuple[DataFrame, list[str]]:
    """Add the columns that decide a site's answer, and return their names.

    Two sites in the same cell of every grid asked for, with the same options,
    have the same series. That combination is a spot.
    """
    codes = {"solar" if p in SOLAR else "meteo": p for p in params}
    columns = {"variant": _site_variant(sites, match_variant)}
    for grid, code in codes.items():
        columns[f"{grid}_lat"] = cell_lat_index(F.col("lat"), F.lit(code))
        columns[f"{grid}_lon"] = cell_lon_index(F.col("lon"), F.lit(code))
    return sites.withColumns(columns), list(columns)


def _spot_cells(spots: DataFrame, params: list[str]) -> DataFrame:
    """One row per spot and parameter, with the parameter's cell."""
    def cell(axis: str) -> Column:
        solar = F.col("param").isin(SOLAR)
        sides = {g: f"{g}_{axis}" for g in ("solar", "meteo") if f"{g}_{axis}" in spots.columns}
        if len(sides) == 1:
            return F.col(next(iter(sides.values())))
        return F.when(solar, F.col(sides["solar"])).otherwise(F.col(sides["meteo"]))
    named = F.explode(F.array(*[F.lit(p) for p in dict.fromkeys(params)]))
    return spots.withColumn("param", named).withColumns({"cell_lat": cell("lat"), "cell_lon": cell("lon")})


def multi_point(store: DataFrame, sites: DataFrame, start: str, end: str, params: list[str],
                temporal: str = "daily", match_variant: bool = True, calendar_if_silent: bool = False,
                end_of_day: bool = False, tiles: list[int] | None = None) -> DataFrame:
    """Wide series of every site: site columns, `obs_ts`, one column per parameter.

    Observations are looked up and made wide once per distinct spot, and only
    then handed to the sites, so the site columns never travel with the pivot and
    sites sharing a cell share the work. The last join is an equi-join whose site
    side adaptive execution can split when one cell holds many sites.
    With `calendar_if_silent`, sites without any row get a NULL calendar. With
    `end_of_day`, an hourly window takes all hours of a bare end date. `tiles` (see
    `site_tiles`) names the store's tiles that the sites lie in.
    """
    carried = [c for c in SITE_COLUMNS if c in sites.columns]
    placed, spot = with_spot(sites, params, match_variant)
    spots = placed.select(*spot).distinct()
    asked = _spot_cells(spots, params)
    window = select_window(store, temporal, params, start, end, end_of_day, tiles)
    wide = to_wide(asked.join(window.select(*CELL_KEY, "obs_ts", "value"), CELL_KEY), [*spot, "obs_ts"], params)
    if calendar_if_silent:
        # Which spots are held needs only the distinct cells; the distinct
        # collapses each cell's history before the shuffle.
        held = asked.join(window.select(*CELL_KEY).distinct(), CELL_KEY, "left_semi").select(*spot)
        silent = spots.join(held, spot, "left_anti").withColumns(
            {"_s": F.lit(iso_bound(start)), "_e": F.lit(last_stamp(end, temporal, end_of_day))})
        blank = calendar(silent, "_s", "_e", temporal).drop("_s", "_e")
        wide = wide.unionByName(blank.withColumns({p: F.lit(None).cast("double") for p in params}))
    return placed.join(wide, spot).select(*carried, "obs_ts", *params)


def multi_point_units(store: DataFrame, sites: DataFrame, start: str, end: str, params: list[str],
                      temporal: str = "daily", match_variant: bool = True) -> DataFrame:
    """The long answer with labels and units; nothing is shuffled after the join."""
    long = multi_point_long(store, sites, start, end, params, temporal, match_variant)
    return with_catalog(long, "param", temporal).select(*long.columns, "label", "unit")
