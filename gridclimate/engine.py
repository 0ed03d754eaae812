"""One object for the everyday questions.

A thin front over the plans: it checks a request once, up front, and returns
lazy DataFrames. Coordinates may be numbers or coordinate text.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.functions import coordinates as coord
from gridclimate.functions.dates import parse_dates
from gridclimate.operators import profile
from gridclimate.operators import requests as req
from gridclimate.plans import points, regions, transects
from gridclimate.sources import catalog as cat
from gridclimate.sources.sites import conform, sites_from_rows
from gridclimate.sources.store import ObservationStore, coverage, fold_coverage

Coordinate = tuple[float | str, float | str]


class ClimateEngine:
    """Answers questions of one resolution from an observation store.

    With `end_of_day`, an hourly question takes all hours of its end date.
    """

    def __init__(self, spark: SparkSession, store: ObservationStore | str | DataFrame, temporal: str = "daily",
                 end_of_day: bool = False):
        if temporal not in ("daily", "hourly"):
            raise ValueError("temporal must be 'daily' or 'hourly'")
        self.spark, self.temporal, self.end_of_day = spark, temporal, end_of_day
        self._store = ObservationStore(spark, store) if isinstance(store, str) else store

    @property
    def rows(self) -> DataFrame:
        """Current content of the store."""
        return self._store.read() if isinstance(self._store, ObservationStore) else self._store

    def _held(self, params: list[str], start: str, end: str, tiles: list[int] | None = None) -> DataFrame:
        """Content that a window of some parameters can need: of a store, only these shelves are listed."""
        if isinstance(self._store, ObservationStore):
            return self._store.read(self.temporal, params, start, end, self.end_of_day, tiles)
        return self._store

    def _tiles(self, find, *args) -> list[int] | None:
        """Tiles of a question, where the store has any."""
        return find(*args) if isinstance(self._store, ObservationStore) else None

    # --- request checks -------------------------------------------------------------

    def _checked(self, start: str, end: str, params: list[str], wind_elevation: float | None = None,
                 box: tuple[float, float, float, float] | None = None) -> tuple[str, str]:
        """Run the request-table checks on this single request; raise on a violation."""
        text = self.spark.createDataFrame([(str(start), str(end), list(params), self.temporal, wind_elevation)],
                                          "s string, e string, params array<string>, temporal string, wind_elevation double")
        dated = parse_dates(parse_dates(text, "s", "start_date"), "e", "end_date")
        if box is None:
            found = req.validate_requests(dated)
        else:
            bounds = dict(zip(("lat_min", "lat_max", "lon_min", "lon_max"), box))
            found = req.validate_regions(dated.withColumns({k: F.lit(float(v)) for k, v in bounds.items()}),
                                         "params", "temporal", "start_date", "end_date")
        row = found.first()
        problems = [x for x in (row["start_date_error"], row["end_date_error"]) if x] + list(row["violations"])
        if problems:
            raise ValueError("; ".join(problems))
        for text in (row["warnings"] if "warnings" in found.columns else None) or ():
            warnings.warn(text, stacklevel=3)
        # a bare date stays one: what it means at the end of a window is for the plans to say
        return tuple(str(row[c])[:10] if len(str(asked).strip()) <= 10 else str(row[c])
                     for c, asked in (("start_date", start), ("end_date", end)))

    def _place(self, lat: float | str, lon: float | str) -> tuple[float, float]:
        """A single coordinate as checked numbers."""
        one = self.spark.createDataFrame([(str(lat), str(lon))], "lat string, lon string")
        row = coord.standardise_sites(one).first()
        if row["coord_error"]:
            raise ValueError(f"{row['coord_error']}: {lat!r}, {lon!r}")
        return row["lat"], row["lon"]

    # --- questions ------------------------------------------------------------------

    def point(self, lat: float | str, lon: float | str, start: str, end: str, params: list[str],
              elevation: float | None = None, wind_elevation: float | None = None,
              wind_surface: str | None = None) -> DataFrame:
        """`obs_ts` and one column per parameter; a NULL calendar when nothing is held."""
        start, end = self._checked(start, end, params, wind_elevation)
        lat, lon = self._place(lat, lon)
        site = sites_from_rows(self.spark, [{"lat": lat, "lon": lon, "elevation": elevation,
                                             "wind_elevation": wind_elevation, "wind_surface": wind_surface}])
        site = site.withColumns({"lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")})
        held = self._held(params, start, end, self._tiles(points.site_tiles, site, params))
        here = points.point_rows(held, lat, lon, start, end, params, self.temporal, self.end_of_day)
        full = points.multi_point(here, site, start, end, params, self.temporal, calendar_if_silent=True,
                                    end_of_day=self.end_of_day)
        return full.select("obs_ts", *params)

    def multi_point(self, sites: DataFrame | Iterable[dict | tuple], start: str, end: str,
                    params: list[str]) -> tuple[DataFrame, DataFrame]:
        """Wide series of every usable site, and the sites that cannot be used with their reason."""
        start, end = self._checked(start, end, params)
        listed = conform(sites) if isinstance(sites, DataFrame) else sites_from_rows(self.spark, sites)
        good, bad = coord.split_sites(coord.standardise_sites(listed))
        low, high = cat.WIND_ELEVATION_RANGE
        windy = F.coalesce(~F.col("wind_elevation").between(low, high), F.lit(False))
        odd = F.col("site_warning").isNotNull() if "site_warning" in good.columns else F.lit(False)
        named = F.col("site_warning") if "site_warning" in good.columns else F.lit(None).cast("string")
        failed = bad.withColumn("reason", F.col("coord_error")).unionByName(
            good.where(windy | odd).withColumn("reason", F.coalesce(named, F.lit(f"wind elevation outside [{low:g}, {high:g}]"))))
        usable = good.where(~windy & ~odd)
        held = self._held(params, start, end, self._tiles(points.site_tiles, usable, params))
        answer = points.multi_point(held, usable, start, end, params, self.temporal, calendar_if_silent=True,
                                    end_of_day=self.end_of_day)
        return answer, failed.select("site_id", "name", "reason")

    def transect(self, first: Coordinate, last: Coordinate, start: str, end: str, params: list[str],
                 num_points: int | None = None, spacing_km: float | None = None) -> DataFrame:
        """Wide series along a line: `obs_ts, lat, lon, name` and one column per parameter."""
        start, end = self._checked(start, end, params)
        if num_points is None and (spacing_km is None or spacing_km <= 0):
            raise ValueError("give num_points or a positive spacing_km")
        line = self.spark.createDataFrame(
            [(0, *self._place(*first), *self._place(*last), num_points, spacing_km, list(params))],
            "transect_id int, lat1 double, lon1 double, lat2 double, lon2 double, num_points int,"
            " spacing_km double, params array<string>")
        samples = transects.transect_points(transects.transect_counts(line)).select(
            F.col("point_no").cast("bigint").alias("site_id"), "lat", "lon", "name")
        held = self._held(params, start, end, self._tiles(points.site_tiles, samples, params))
        return points.multi_point(held, samples, start, end, params, self.temporal, calendar_if_silent=True,
                                    end_of_day=self.end_of_day).select(
            "obs_ts", "lat", "lon", "name", *params)

    def region(self, lat_min: float, lat_max: float, lon_min: float, lon_max: float, start: str, end: str,
               params: list[str]) -> DataFrame:
        """Daily values of one parameter in a box: `obs_ts, lat, lon` and the parameter."""
        start, end = self._checked(start, end, params, box=(lat_min, lat_max, lon_min, lon_max))
        box = self.spark.createDataFrame([(0, params[0], *map(float, (lat_min, lat_max, lon_min, lon_max)))],
                                         "region_id int, param string, lat_min double, lat_max double,"
                                         " lon_min double, lon_max double")
        held = self._held(params, start, end, self._tiles(regions.region_tiles, box))
        found = regions.region_query(held, box, start, end, params=params[:1], bounds=(lat_min, lat_max), few=True)
        return found.select("obs_ts", "lat", "lon", F.col("value").alias(params[0]))

    def region_between(self, south_west: Coordinate, north_east: Coordinate, start: str, end: str,
                       params: list[str]) -> DataFrame:
        """The same from two corners."""
        (lat_min, lon_min), (lat_max, lon_max) = self._place(*south_west), self._place(*north_east)
        return self.region(lat_min, lat_max, lon_min, lon_max, start, end, params)

    # --- store and catalogue ----------------------------------------------------------

    def fetch_plan(self, requests: DataFrame, keys: list[str]) -> DataFrame:
        """Ranges still to be downloaded for a request table with `start_date` and `end_date`."""
        if isinstance(self._store, ObservationStore):  # kept up to date by the appends
            held = fold_coverage(self._store.coverage().where(F.col("temporal") == self.temporal), keys)
        else:
            held = coverage(self.rows.where(F.col("temporal") == self.temporal), keys)
        asked = requests.withColumn("temporal", F.lit(self.temporal))
        return req.fetch_plan(req.missing_ranges(asked, held, keys))

    def parameters(self, group: str = "all") -> DataFrame:
        return cat.catalog_group(self.spark, group)

    def summarize(self, answer: DataFrame, params: list[str]) -> DataFrame:
        """One-row profile of an answer."""
        return profile.profile_wide(answer, params).withColumn("temporal", F.lit(self.temporal))
