"""Bounding-box questions: all cells whose centre lies in a box.

A box is turned into the list of its cell indexes and joined on equality, so
there is no range join however many boxes are asked. With `wrap`, longitudes are a circle:
a box whose `lon_min` is above its `lon_max` runs east across the antimeridian.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclimate.functions.grid import asked_tiles, cell_centre_lat, cell_centre_lon, cell_lat_index, grid_value
from gridclimate.operators.requests import box_checks
from gridclimate.sources.catalog import MAX_BOX_DEGREES
from gridclimate.sources.store import select_window


def east_edge(wrap: bool) -> Column:
    """Upper longitude of a box on an axis that goes on beyond 180 where the box does."""
    lon_min, lon_max = F.col("lon_min"), F.col("lon_max")
    return F.when(lon_min > lon_max, lon_max + 360.0).otherwise(lon_max) if wrap else lon_max


def _indexes(low: Column, high: Column, step: str, shift: float) -> Column:
    place = lambda v: F.floor((v + shift) / grid_value(F.col("param"), step) + grid_value(F.col("param"), "anchor") - 0.5)
    return F.sequence(place(low), place(high) + 1)


def _region_rows(regions: DataFrame) -> DataFrame:
    """One row per box and row of the grid whose centre it spans: adds `_la`."""
    rows = regions.withColumn("_la", F.explode(_indexes(F.col("lat_min"), F.col("lat_max"), "lat_step", 90.0)))
    return (rows.where(cell_centre_lat(F.col("_la"), F.col("param")).between(F.col("lat_min"), F.col("lat_max")))
            .where(F.col("_la").between(0, grid_value(F.col("param"), "n_lat") - 1)))


def region_cells(regions: DataFrame, wrap: bool = False) -> DataFrame:
    """One row per box and cell: adds `cell_lat, cell_lon, lat, lon` (the cell centre).

    Takes `lat_min, lat_max, lon_min, lon_max, param`; bounds are inclusive. The
    index range is one cell generous and the exact centre test decides. With `wrap` a box may
    cross the antimeridian; the cell on it is listed once, with the longitude of its own index.
    """
    param = F.col("param")
    rows = _region_rows(regions).withColumn("lat", cell_centre_lat(F.col("_la"), param))
    rows = rows.withColumn("_lo", F.explode(_indexes(F.col("lon_min"), east_edge(wrap), "lon_step", 180.0)))
    column = F.pmod(F.col("_lo"), grid_value(param, "n_lon").cast("bigint"))
    rows = rows.withColumn("lon", cell_centre_lon(F.col("_lo"), param)).where(F.col("lon").between(F.col("lon_min"), east_edge(wrap)))
    if wrap:  # once round the globe at most
        first = F.floor((F.col("lon_min") + 180.0) / grid_value(param, "lon_step") + grid_value(param, "anchor") - 0.5)
        rows = rows.where(F.col("_lo") - first < grid_value(param, "n_lon")).withColumn("lon", cell_centre_lon(column, param))
    return (rows.withColumns({"cell_lat": F.col("_la").cast("int"), "cell_lon": column.cast("int")}).drop("_la", "_lo"))


def region_tiles(regions: DataFrame, wrap: bool = False) -> list[int]:
    """Tiles of the store that the boxes touch."""
    return asked_tiles(region_cells(regions, wrap))


def region_query(store: DataFrame, regions: DataFrame, start: str, end: str, enforce_span: bool = True,
                 key: str = "region_id", params: list[str] | None = None,
                 bounds: tuple[float, float] | None = None, wrap: bool = False, tiles: list[int] | None = None,
                 few: bool = False) -> DataFrame:
    """Daily values of every cell in every valid box: `key, param, obs_ts, lat, lon, value`.

    Boxes that break a rule are left out; `validate_regions` reports them. With
    `enforce_span=False` boxes of any size are answered. `params` names the
    parameters that the boxes ask for, `bounds` the latitudes they span and `tiles` the tiles of the
    store they touch, so the scan prunes by them whatever join is chosen. `few` says that the boxes are a
    handful, whose cells may be sent to every task.
    """
    valid = regions.where(F.size(F.array_compact(F.array(*box_checks(enforce_span, wrap)))) == 0)
    cells = region_cells(valid, wrap).select(key, "param", "cell_lat", "cell_lon", "lat", "lon")
    if params:
        valid = valid.where(F.col("param").isin(list(params)))
    window = select_window(store, "daily", params, start, end, tiles=tiles)
    if bounds:
        rows = [(cell_lat_index(F.lit(float(bounds[0])), F.col("param")) - 1), (cell_lat_index(F.lit(float(bounds[1])), F.col("param")) + 1)]
        if params and len(params) == 1:  # plain numbers reach the row groups
            rows = [cell_lat_index(F.lit(float(b)), F.lit(params[0])) + d for b, d in zip(bounds, (-1, 1))]
        window = window.where(F.col("cell_lat").between(*rows))
    window = (window.where(F.col("variant") == "base")
              .select("param", "cell_lat", "cell_lon", "obs_ts", "value"))
    return _join_cells(cells, window, few).select(key, "param", "obs_ts", "lat", "lon", "value")


def _join_cells(cells: DataFrame, window: DataFrame, few: bool = False) -> DataFrame:
    """Cells of boxes with their stored rows.

    The planner sizes a list of cells by the boxes it came from, hundreds of times too small, and never takes
    a broadcast chosen so early back; so unless the boxes are known to be few, both sides are shuffled.
    """
    return (cells if few else cells.hint("merge")).join(window, ["param", "cell_lat", "cell_lon"])


def tile_boxes(regions: DataFrame, key: str = "region_id", span: float = MAX_BOX_DEGREES, wrap: bool = False) -> DataFrame:
    """Cut boxes into tiles no wider than `span`, for services with a size limit.

    Adds `tile_no` and replaces the bounds. Neighbouring tiles share an edge, so
    rows on an edge arrive twice and `tiled_rows` drops the repeat. With `wrap`, a box across the
    antimeridian is cut there first, so no tile crosses it.
    """
    def cut(low: Column, high: Column) -> Column:
        n = F.greatest(F.ceil((high - low) / span), F.lit(1))
        width = (high - low) / n
        return F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.struct(
            (low + i * width).alias("low"), F.when(i == n - 1, high).otherwise(low + (i + 1) * width).alias("high")))

    lon_min, lon_max = F.col("lon_min"), F.col("lon_max")
    lon = cut(lon_min, lon_max)
    if wrap:
        lon = F.when(lon_min > lon_max, F.concat(cut(lon_min, F.lit(180.0)), cut(F.lit(-180.0), lon_max))).otherwise(lon)
    keep = [c for c in regions.columns if c not in ("lat_min", "lat_max", "lon_min", "lon_max")]
    rows = (regions.withColumns({"_lat": cut(F.col("lat_min"), F.col("lat_max")), "_lon": lon})
            .select(*keep, "_lon", F.posexplode("_lat").alias("_i", "_a"))
            .select(*keep, "_i", "_a", F.size("_lon").alias("_w"), F.posexplode("_lon").alias("_j", "_b")))
    return rows.select(*keep, (F.col("_i") * F.col("_w") + F.col("_j") + 1).alias("tile_no"),
                       F.col("_a.low").alias("lat_min"), F.col("_a.high").alias("lat_max"),
                       F.col("_b.low").alias("lon_min"), F.col("_b.high").alias("lon_max"))


def _distinct_cells(tiled: DataFrame, key: str) -> DataFrame:
    """Cells of the tiles of every box, each once: `key, param, cell_lat, cell_lon, lat, lon`.

    Tiles are dealt by key and row of the grid, where their spans of columns are merged, so
    the cells are listed once and nothing is held per cell. Longitudes are a circle.
    """
    param = F.col("param")
    n_lon = grid_value(param, "n_lon").cast("bigint")
    place = lambda v: F.floor((v + 180.0) / grid_value(param, "lon_step") + grid_value(param, "anchor") - 0.5)
    low, high = place(F.col("lon_min")), place(F.col("lon_max"))
    # first and last column with their centre inside, as the exact centre test has it
    first = F.when(cell_centre_lon(low, param) >= F.col("lon_min"), low).otherwise(low + 1)
    last = (F.when(cell_centre_lon(high + 1, param) <= F.col("lon_max"), high + 1)
            .when(cell_centre_lon(high, param) <= F.col("lon_max"), high).otherwise(high - 1))
    rows = (_region_rows(tiled).select(key, "param", "_la", first.alias("first"), last.alias("last"))
            .where("first <= last").repartition(key, "param", "_la"))
    spans = rows.groupBy(key, "param", "_la").agg(F.collect_set(F.struct("first", "last")).alias("_spans"))
    columns = F.flatten(F.transform("_spans", lambda s: F.transform(F.sequence(s["first"], s["last"]), lambda i: F.pmod(i, n_lon))))
    cells = spans.select(key, "param", "_la", F.explode(F.array_distinct(columns)).alias("_lo"))
    return cells.select(key, "param", F.col("_la").cast("int").alias("cell_lat"), F.col("_lo").cast("int").alias("cell_lon"),
                        cell_centre_lat(F.col("_la"), param).alias("lat"), cell_centre_lon(F.col("_lo"), param).alias("lon"))


def tiled_rows(store: DataFrame, tiled: DataFrame, start: str, end: str, key: str = "region_id",
               params: list[str] | None = None, tiles: list[int] | None = None) -> DataFrame:
    """Rows of boxes that were cut by `tile_boxes`, each cell once: `key, param, obs_ts, lat, lon, value`.

    The repeat of a shared edge is dropped among the cells, before any history is joined. +180 and
    -180 are one meridian, so its cell also counts once.
    """
    valid = tiled.where(F.size(F.array_compact(F.array(*box_checks()))) == 0)
    cells = _distinct_cells(valid, key)
    window = select_window(store, "daily", params, start, end, tiles=tiles).where(F.col("variant") == "base")
    return (_join_cells(cells, window.select("param", "cell_lat", "cell_lon", "obs_ts", "value"))
            .select(key, "param", "obs_ts", "lat", "lon", "value"))
