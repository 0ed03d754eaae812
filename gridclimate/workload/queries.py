"""Registered queries: each one an operator over the driver's tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.functions import coordinates as coord
from gridclimate.functions import sqlfuncs
from gridclimate.functions.dates import ensure_date_column, parse_dates
from gridclimate.functions.text import round_half_even
from gridclimate.functions.grid import cell_centre_lat, cell_centre_lon
from gridclimate.operators import merge, profile, requests as req
from gridclimate.plans import points, regions, transects
from gridclimate.sources import responses as resp
from gridclimate.sources import catalog as cat
from gridclimate.sources.sinks import write_result
from gridclimate.sources.sites import read_site_csv
from gridclimate.sources.store import coverage, select_window, upsert
from gridclimate.workload import streams
from gridclimate.workload import views as v

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

START, END = "2024-01-05", "2024-01-25"
PARAMS = ["T2M", "RH2M", "PRECTOTCORR", "WS10M", "ALLSKY_SFC_SW_DWN"]
WIDE = ", ".join(f"max(case when param = '{p}' then value end) as \"{p}\"" for p in PARAMS)
WINDOW = f"obs_date between date '{START}' and date '{END}'"


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        TWINS[name] = v.twin(sql)
        return fn
    return add


def r6(column: str) -> F.Column:
    return F.round(column, 6).alias(column)


# --- ingest ---------------------------------------------------------------------------

def _event_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed point response per event, with fill codes and unreadable values."""
    raw = v.view(spark, sf_dir, "v_obs_raw")
    value = (F.when(F.col("seq") % 17 == 0, F.lit("n/a")).otherwise(F.col("raw_value").cast("string")))
    series = F.create_map(F.date_format("obs_date", "yyyyMMdd"), value)
    body = F.to_json(F.struct(F.struct(F.create_map("param", series).alias("parameter")).alias("properties")))
    return raw.select(F.col("seq").alias("response_id"), "site_id", body.alias("body"))


@query("ingest_point", """
select seq as response_id, site_id, param, cast(obs_date as timestamp) as obs_ts, 'daily' as temporal,
       case when seq % 17 = 0 then null else nullif(raw_value, -999) end as value
from v_obs_raw""")
def ingest_point(spark, sf_dir):
    return resp.ingest_point(_event_bodies(spark, sf_dir)).select(
        "response_id", "site_id", "param", "obs_ts", "temporal", "value")


@query("ingest_datekeys", """
select event_id as response_id,
       case event_id % 4 when 0 then 'daily' when 1 then 'hourly' when 3 then 'daily' end as temporal,
       case event_id % 4 when 0 then date_trunc('day', ts) when 1 then date_trunc('hour', ts) end as obs_ts,
       value,
       case event_id % 4 when 2 then 'unrecognised date key' when 3 then 'unreadable date key' end as reason
from events""")
def ingest_datekeys(spark, sf_dir):
    events = v.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    key = (F.when(kind == 0, F.date_format("ts", "yyyyMMdd")).when(kind == 1, F.date_format("ts", "yyyyMMddHH"))
           .when(kind == 2, F.date_format("ts", "yyyyMM")).otherwise(F.concat(F.date_format("ts", "yyyy"), F.lit("1399"))))
    series = F.create_map(key, F.col("value").cast("string"))
    body = F.to_json(F.struct(F.struct(F.create_map(F.lit("T2M"), series).alias("parameter")).alias("properties")))
    landed = events.select(F.col("event_id").alias("response_id"), body.alias("body"))
    reason = F.when(F.col("obs_ts").isNotNull(), F.lit(None).cast("string")).when(
        F.col("temporal").isNull(), F.lit("unrecognised date key")).otherwise(F.lit("unreadable date key"))
    return resp.point_values(landed).select("response_id", "temporal", "obs_ts", "value", reason.alias("reason"))


def _status_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = v.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 5
    good = F.lit('{"properties":{"parameter":{"T2M":{"20240101":1.5}}}}')
    body = (F.when(kind == 1, F.concat(F.lit('{"messages":["bad '), F.col("event_type"), F.lit('","user '),
                                       F.col("user_id").cast("string"), F.lit('"]}')))
            .when(kind == 2, F.concat(F.lit('{"error":"no data for '), F.col("event_type"), F.lit('"}')))
            .when(kind == 3, F.lit('{"properties":{"parameter":{"T2M":{"2024'))
            .when(kind == 4, F.lit("Server Error")).otherwise(good))
    status = F.when(kind == 1, F.lit(422)).when(kind == 4, F.lit(500)).otherwise(F.lit(200))
    return events.select(F.col("event_id").alias("response_id"), "user_id", body.alias("body"), status.alias("http_status"))


@query("ingest_errors", """
select event_id as response_id, user_id,
       cast(case event_id % 5 when 1 then 422 when 4 then 500 else 200 end as int) as http_status,
       case event_id % 5 when 1 then 'HTTP 422: bad ' || event_type || '; user ' || user_id
            when 2 then 'no data for ' || event_type when 3 then 'not JSON' else 'HTTP 500' end as reason
from events where event_id % 5 <> 0""")
def ingest_errors(spark, sf_dir):
    return resp.response_errors(_status_bodies(spark, sf_dir)).select("response_id", "user_id", "http_status", "reason")


@query("ingest_regional", """
select seq as response_id, p.lat, p.lon, p.elevation, param, cast(obs_date as timestamp) as obs_ts,
       nullif(raw_value, -999) as value
from v_obs_raw o join v_points p on p.site_id = o.site_id""")
def ingest_regional(spark, sf_dir):
    sites = v.view(spark, sf_dir, "v_points").select("site_id", "lat", "lon", "elevation")
    raw = v.view(spark, sf_dir, "v_obs_raw").join(sites, "site_id")
    series = F.create_map(F.date_format("obs_date", "yyyyMMdd"), F.col("raw_value").cast("string"))
    values = F.struct(F.create_map("param", series).alias("parameter"))

    def feature(place):
        return F.struct(F.struct(place.alias("coordinates")).alias("geometry"), values.alias("properties"))
    # The second feature lacks a latitude and must be skipped.
    body = F.to_json(F.struct(F.array(feature(F.array_compact(F.array("lon", "lat", "elevation"))),
                                      feature(F.array("lon"))).alias("features")))
    return resp.ingest_region(raw.select(F.col("seq").alias("response_id"), body.alias("body"))).select(
        "response_id", "lat", "lon", "elevation", "param", "obs_ts", "value")


def _regional_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One regional answer per event; by turns usable, beside the globe, with an hourly key, refused or cut off."""
    sites = v.view(spark, sf_dir, "v_points").select("site_id", "lat", "lon")
    raw, kind = v.view(spark, sf_dir, "v_obs_raw").join(sites, "site_id"), F.col("seq") % 6
    day = F.date_format("obs_date", "yyyyMMdd")
    series = F.create_map(F.when(kind == 2, F.concat(day, F.lit("00"))).otherwise(day), F.col("raw_value").cast("string"))
    spot = F.array(F.when(kind == 1, F.col("lon") + 400.0).otherwise(F.col("lon")), F.col("lat"))
    feature = F.struct(F.struct(spot.alias("coordinates")).alias("geometry"), F.struct(F.create_map("param", series).alias("parameter")).alias("properties"))
    body = (F.when(kind == 3, F.lit('{"messages":["no such area","try another"]}')).when(kind == 4, F.lit('{"features":[{"geom'))
            .otherwise(F.to_json(F.struct(F.array(feature).alias("features")))))
    return raw.select(F.col("seq").alias("response_id"), body.alias("body"))


@query("region_quarantine", """
select seq as response_id, case when seq % 6 = 2 then param end as param, case when seq % 6 = 2 then strftime(obs_date, '%Y%m%d') || '00' end as date_key,
       case seq % 6 when 1 then 'coordinates out of range' when 2 then 'no daily date key' when 3 then 'no such area; try another' else 'not JSON' end as reason
from v_obs_raw join v_points using (site_id) where seq % 6 in (1, 2, 3, 4)""")
def region_quarantine(spark, sf_dir):
    return resp.region_quarantine(_regional_bodies(spark, sf_dir)).select("response_id", "param", "date_key", "reason")


@query("region_store_rows", """
select o.seq as response_id, s.param, s.cell_lat, s.cell_lon, cast(obs_date as timestamp) as obs_ts, nullif(raw_value, -999) as value, 'daily' as temporal, 'base' as variant
from v_obs_raw o join v_site_cells s on s.site_id = o.site_id and s.param = o.param where o.seq % 6 in (0, 5)""")
def region_store_rows(spark, sf_dir):
    return resp.region_store_rows(_regional_bodies(spark, sf_dir)).select(
        "response_id", "param", "cell_lat", "cell_lon", "obs_ts", "value", "temporal", "variant")


@query("export_roundtrip", "select site_id, param, cast(obs_date as timestamp) as obs_ts, value from v_obs")
def export_roundtrip(spark, sf_dir):
    obs = v.observations(spark, sf_dir)
    written = resp.export_responses(obs, ["site_id"])
    landed = written.select("site_id", F.concat_ws("/", "site_id", "year").alias("response_id"), "body")
    return resp.ingest_point(landed).select("site_id", "param", "obs_ts", "value")


@query("export_roundtrip_hourly", "select site_id, param, cast(hr as timestamp) as obs_ts, value from v_hourly")
def export_roundtrip_hourly(spark, sf_dir):
    written = resp.export_responses(v.hourly_observations(spark, sf_dir), ["site_id"], "hourly")
    landed = written.select("site_id", F.concat_ws("/", "site_id", "year").alias("response_id"), "body")
    return resp.ingest_point(landed).select("site_id", "param", "obs_ts", "value")


@query("site_list_csv", """
select 'site-' || site_id as site_id, cast(lat as double) as lat, cast(lon as double) as lon, name,
       case when site_id % 7 <> 0 then elevation end as elevation, cast(null as double) as wind_elevation,
       case when site_id % 7 = 0 then 'unreadable elevation' end as site_warning from v_points""")
def site_list_csv(spark, sf_dir):
    path = streams.run_folder(spark, "sites") + "/list"
    sites = v.view(spark, sf_dir, "v_points")
    # ids are text, and some elevations are no numbers
    text = sites.withColumns({"site_id": F.concat(F.lit("site-"), F.col("site_id").cast("string")),
                              "elevation": F.when(F.col("site_id") % 7 == 0, F.lit("high")).otherwise(F.col("elevation").cast("string"))})
    write_result(text, path, "csv")
    return read_site_csv(spark, path).select("site_id", F.col("lat").cast("double"), F.col("lon").cast("double"), "name", "elevation", "wind_elevation", "site_warning")


@query("sql_functions", """
select site_id, cell_lat, cell_lon, format('{:.5f}', abs(lat)) || '° ' || case when lat >= 0 then 'N' else 'S' end as lat_text,
       lat as lat_back, case when elevation is not null then greatest(elevation - 10, 0) end as above
from v_site_cells where param = 'T2M'""")
def sql_functions(spark, sf_dir):
    sqlfuncs.register(spark)
    return spark.sql("""
        select site_id, gc_cell_lat(lat, 'T2M') as cell_lat, gc_cell_lon(lon, 'T2M') as cell_lon, gc_format_dd(lat, true) as lat_text,
               gc_parse_coord(gc_format_dd(lat, true), true) as lat_back, gc_gdd(elevation, 10e0) as above from {sites}""",
                     sites=v.view(spark, sf_dir, "v_points"))


@query("fill_to_null", "select seq, site_id, param, nullif(raw_value, -999) as value from v_obs_raw")
def fill_to_null(spark, sf_dir):
    raw = v.view(spark, sf_dir, "v_obs_raw")
    return raw.select("seq", "site_id", "param", resp.fill_to_null(F.col("raw_value")).alias("value"))


# --- catalogue and grid -----------------------------------------------------------------

@query("catalog_units", """
select o.param, c.label, c.short_name, c.unit_daily, c.unit_hourly, c.source_family, count(*) as n_obs
from v_obs o left join v_catalog c on c.param = o.param group by all""")
def catalog_units(spark, sf_dir):
    per_param = v.observations(spark, sf_dir).groupBy("param").agg(F.count("*").alias("n_obs"))
    daily = cat.with_catalog(per_param, resolution="daily").withColumnRenamed("unit", "unit_daily")
    hourly = F.broadcast(cat.catalog(spark).select("param", F.col("units.hourly").alias("unit_hourly")))
    return daily.join(hourly, "param", "left").select(
        "param", "label", "short_name", "unit_daily", "unit_hourly", "source_family", "n_obs")


@query("catalog_group", """
select c.param, c.label, count(o.param) as n_obs, round(avg(o.value), 6) as mean_value
from v_obs o join v_catalog c on c.param = o.param where c.in_default group by all""")
def catalog_group(spark, sf_dir):
    group = F.broadcast(cat.catalog_group(spark, "default").select("param", "label"))
    sums = v.observations(spark, sf_dir).groupBy("param").agg(
        F.count("*").alias("n_obs"), F.avg("value").alias("mean_value"))
    return sums.join(group, "param").select("param", "label", "n_obs", r6("mean_value"))


@query("catalog_grid", """
select event_id, coalesce(c.param, o.code) as param, coalesce(lat_step, 0.5) as grid_lat_step,
       coalesce(lon_step, 0.625) as grid_lon_step, source_family
from (select event_id, case event_type when 'view' then 'T2M' when 'click' then 'ALLSKY_SFC_SW_DWN'
             when 'purchase' then 'GWETTOP' else upper(event_type) end as code from events) o
left join v_catalog c on c.param = o.code""")
def catalog_grid(spark, sf_dir):
    asked = v.table(spark, sf_dir, "events").select("event_id", F.expr(
        "case event_type when 'view' then 'T2M' when 'click' then 'ALLSKY_SFC_SW_DWN'"
        " when 'purchase' then 'GWETTOP' else upper(event_type) end").alias("param"))
    return cat.with_catalog(asked).select("event_id", "param", "grid_lat_step", "grid_lon_step", "source_family")


@query("grid_cell", """
select site_id, param, cell_lat, cell_lon,
       case when param like 'ALLSKY%' then cell_lat + 0.5 - 90 else cell_lat * 0.5e0 - 90 end::double as centre_lat,
       case when param like 'ALLSKY%' then cell_lon + 0.5 - 180 else cell_lon * 0.625e0 - 180 end::double as centre_lon
from v_site_cells where param in ('T2M', 'ALLSKY_SFC_SW_DWN')""")
def grid_cell(spark, sf_dir):
    cells = points.site_cells(v.view(spark, sf_dir, "v_points"), ["T2M", "ALLSKY_SFC_SW_DWN"])
    return cells.select("site_id", "param", "cell_lat", "cell_lon",
                        cell_centre_lat(F.col("cell_lat"), F.col("param")).alias("centre_lat"),
                        cell_centre_lon(F.col("cell_lon"), F.col("param")).alias("centre_lon"))


@query("distinct_cells", """
select param, count(distinct (cell_lat, cell_lon)) as n_cells, count(*) as n_sites
from v_site_cells where param in ('T2M', 'ALLSKY_SFC_SW_DWN') group by param""")
def distinct_cells(spark, sf_dir):
    cells = points.site_cells(v.view(spark, sf_dir, "v_points"), ["T2M", "ALLSKY_SFC_SW_DWN"])
    per_cell = cells.groupBy("param", "cell_lat", "cell_lon").agg(F.count("*").alias("n"))
    return per_cell.groupBy("param").agg(F.count("*").alias("n_cells"), F.sum("n").alias("n_sites"))


# --- store ------------------------------------------------------------------------------

@query("coverage", """
select site_id, param, cast(min(obs_date) as timestamp) as held_min, cast(max(obs_date) as timestamp) as held_max,
       count(*) as held_rows from v_obs group by site_id, param""")
def coverage_query(spark, sf_dir):
    return coverage(v.observations(spark, sf_dir), ["site_id", "param"])


@query("merge_keep_first", """
select site_id, param, cast(obs_date as timestamp) as obs_ts, value, src as source from (
  select *, row_number() over (partition by site_id, param, obs_date order by src, seq) as rn from (
    select site_id, param, obs_date, seq, value, 0 as src from v_held
    union all
    select site_id, param, obs_date, seq, nullif(raw_value, -999), 1 from v_obs_raw where obs_date <= date '2024-01-12'
    union all
    select site_id, param, obs_date, seq, nullif(raw_value, -999), 2 from v_obs_raw where obs_date >= date '2024-01-10') a) b
where rn = 1""")
def merge_keep_first(spark, sf_dir):
    held = _held(spark, sf_dir)
    raw = v.view(spark, sf_dir, "v_obs_raw").select(
        "site_id", "param", F.col("obs_date").cast("timestamp_ntz").alias("obs_ts"), "seq",
        resp.fill_to_null(F.col("raw_value")).alias("value"))
    early = select_window(raw, end="2024-01-12")
    late = select_window(raw, start="2024-01-10")
    return merge.merge_keep_first([held, early, late], ["site_id", "param", "obs_ts"], "seq")


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_window(v.observations(spark, sf_dir), start="2024-01-05", end="2024-01-20")


@query("store_upsert", """
with held as (select site_id, param, obs_date, value from v_held),
batch as (select site_id, param, obs_date, value from (
            select *, row_number() over (partition by site_id, param, obs_date order by seq desc) as rn
            from (select site_id, param, obs_date, seq, nullif(raw_value, -999) as value from v_obs_raw) a) b where rn = 1)
select site_id, param, cast(obs_date as timestamp) as obs_ts, value from held
union all
select site_id, param, cast(obs_date as timestamp), value from batch b
where not exists (select 1 from held h where h.site_id = b.site_id and h.param = b.param and h.obs_date = b.obs_date)""")
def store_upsert(spark, sf_dir):
    held = _held(spark, sf_dir).select("site_id", "param", "obs_ts", "value")
    # The batch ranks repeats backwards, so a wrong winner would show.
    batch = v.view(spark, sf_dir, "v_obs_raw").select(
        "site_id", "param", F.col("obs_date").cast("timestamp_ntz").alias("obs_ts"),
        resp.fill_to_null(F.col("raw_value")).alias("value"), (-F.col("seq")).alias("rank"))
    return upsert(held, batch, ["site_id", "param", "obs_ts"], "rank")


@query("store_stats", """
select count(*) as entries, min(ts) as oldest, max(ts) as newest, cast(sum(strlen(props)) as bigint) as total_bytes,
       case when sum(strlen(props)) < 1024 then format('{:.2f} B', sum(strlen(props))::double)
            when sum(strlen(props)) < 1048576 then format('{:.2f} KiB', sum(strlen(props)) / 1024e0)
            else format('{:.2f} MiB', sum(strlen(props)) / 1048576e0) end as total_size
from events""")
def store_stats(spark, sf_dir):
    return profile.store_stats(v.table(spark, sf_dir, "events"), "ts", "props")


# --- point questions --------------------------------------------------------------------

@query("window_filter", f"""
select param, cell_lat, cell_lon, cast(obs_date as timestamp) as obs_ts, value from v_store
where {WINDOW} and param in ('T2M', 'RH2M')""")
def window_filter(spark, sf_dir):
    return select_window(v.store(spark, sf_dir), "daily", ["T2M", "RH2M"], START, END).select(
        "param", "cell_lat", "cell_lon", "obs_ts", "value")


@query("wide_params", f"""
select site_id, cast(obs_date as timestamp) as obs_ts, {WIDE}, cast(null as double) as "PS"
from v_obs group by site_id, obs_date""")
def wide_params(spark, sf_dir):
    return points.to_wide(v.observations(spark, sf_dir), ["site_id", "obs_ts"], [*PARAMS, "PS"])


POINT_LAT, POINT_LON = -68.70, -164.41


@query("point_query", f"""
select cast(obs_date as timestamp) as obs_ts, {WIDE} from v_store
where {WINDOW} and case when param like 'ALLSKY%'
  then cell_lat = floor({POINT_LAT} + 90) and cell_lon = floor({POINT_LON} + 180)
  else cell_lat = floor(({POINT_LAT} + 90) / 0.5e0 + 0.5e0) and cell_lon = floor(({POINT_LON} + 180) / 0.625e0 + 0.5e0) end
group by obs_date""")
def point_query(spark, sf_dir):
    return points.point_query(v.store(spark, sf_dir), POINT_LAT, POINT_LON, START, END, PARAMS)


@query("multi_point", f"""
select site_id, lat, lon, name, elevation, cast(obs_date as timestamp) as obs_ts, {WIDE}
from v_site_cells s join v_store o using (param, cell_lat, cell_lon)
where {WINDOW} and param in ({', '.join(repr(p) for p in PARAMS)}) group by all""")
def multi_point(spark, sf_dir):
    return points.multi_point(v.store(spark, sf_dir), v.view(spark, sf_dir, "v_points"), START, END, PARAMS,
                              match_variant=False)


@query("multi_point_adjusted", f"""
select site_id, lat, lon, name, s.elevation, cast(obs_date as timestamp) as obs_ts, {WIDE}
from v_site_cells s join v_store_adjusted o
  on s.param = o.param and s.cell_lat = o.cell_lat and s.cell_lon = o.cell_lon and s.elevation is not distinct from o.elevation
where {WINDOW} and s.param in ({', '.join(repr(p) for p in PARAMS)}) group by all""".replace("case when param", "case when s.param"))
def multi_point_adjusted(spark, sf_dir):
    return points.multi_point(v.store(spark, sf_dir, adjusted=True), v.view(spark, sf_dir, "v_points"),
                              START, END, PARAMS)


@query("multi_point_units", f"""
select site_id, lat, lon, name, elevation, s.param, cast(obs_date as timestamp) as obs_ts, value, label, unit_daily as unit
from v_site_cells s join v_store o using (param, cell_lat, cell_lon) join v_catalog c on c.param = s.param
where {WINDOW} and s.param in ('T2M', 'ALLSKY_SFC_SW_DWN')""")
def multi_point_units(spark, sf_dir):
    return points.multi_point_units(v.store(spark, sf_dir), v.view(spark, sf_dir, "v_points"), START, END,
                                    ["T2M", "ALLSKY_SFC_SW_DWN"], match_variant=False)


@query("null_skeleton", f"""
with hit as (select distinct site_id from v_site_cells s join v_store o using (param, cell_lat, cell_lon)
             where {WINDOW} and param in ('T2M', 'WS10M')),
found as (select site_id, lat, lon, name, elevation, cast(obs_date as timestamp) as obs_ts,
                 max(case when param = 'T2M' then value end) as "T2M", max(case when param = 'WS10M' then value end) as "WS10M"
          from v_site_cells s join v_store o using (param, cell_lat, cell_lon)
          where {WINDOW} and param in ('T2M', 'WS10M') group by all)
select * from found
union all
select site_id, lat, lon, name, elevation, cast(d.d as timestamp), null::double, null::double
from v_points p, (select unnest(generate_series(date '{START}', date '{END}', interval 1 day)) as d) d
where site_id not in (select site_id from hit)""")
def null_skeleton(spark, sf_dir):
    return points.multi_point(v.store(spark, sf_dir), v.view(spark, sf_dir, "v_points"), START, END,
                              ["T2M", "WS10M"], match_variant=False, calendar_if_silent=True)


HOURS = f"cast(hr as date) between date '{START}' and date '2024-01-07'"


@query("multi_point_hourly", f"""
select p.site_id, p.lat, p.lon, p.name, p.elevation, cast(hr as timestamp) as obs_ts, max(case when s.param = 'T2M' then value end) as "T2M",
       max(case when s.param = 'WS10M' then value end) as "WS10M"
from v_site_cells s join v_store_hourly o using (param, cell_lat, cell_lon) join v_points p on p.site_id = s.site_id
where {HOURS} and s.param in ('T2M', 'WS10M') group by all""")
def multi_point_hourly(spark, sf_dir):
    return points.multi_point(v.hourly_store(spark, sf_dir), v.view(spark, sf_dir, "v_points"), START, "2024-01-07",
                              ["T2M", "WS10M"], temporal="hourly", match_variant=False, end_of_day=True)


@query("null_skeleton_hourly", f"""
with hit as (select distinct s.site_id from v_site_cells s join v_store_hourly o using (param, cell_lat, cell_lon)
             where {HOURS} and param in ('T2M', 'WS10M'))
select site_id, cast(h as timestamp) as obs_ts
from v_points p, (select unnest(generate_series(timestamp '{START} 00:00:00', timestamp '2024-01-07 23:00:00', interval 1 hour)) as h) d
where site_id not in (select site_id from hit)""")
def null_skeleton_hourly(spark, sf_dir):
    sites, held = v.view(spark, sf_dir, "v_points"), v.hourly_store(spark, sf_dir)
    ask = {"temporal": "hourly", "match_variant": False, "end_of_day": True}
    full = points.multi_point(held, sites, START, "2024-01-07", ["T2M", "WS10M"], calendar_if_silent=True, **ask)
    answered = points.multi_point(held, sites, START, "2024-01-07", ["T2M", "WS10M"], **ask).select("site_id").distinct()
    return full.join(answered, "site_id", "left_anti").select("site_id", "obs_ts")


# --- summaries --------------------------------------------------------------------------

@query("mean_by_site", f"""
select name, round(avg(value), 6) as mean_t2m
from v_site_cells s join v_store o using (param, cell_lat, cell_lon)
where param = 'T2M' and {WINDOW} group by name""")
def mean_by_site(spark, sf_dir):
    long = points.multi_point_long(v.store(spark, sf_dir), v.view(spark, sf_dir, "v_points"), START, END, ["T2M"],
                                   match_variant=False)
    return long.groupBy("name").agg(F.round(F.avg("value"), 6).alias("mean_t2m"))


@query("window_totals", """
with wide as (select site_id, param, value, cast(value::varchar as decimal(28, 15)) as exact from v_obs where """ + WINDOW + """)
select site_id, round_even(100 * (cast(sum(case when param = 'T2M' then exact end) as double) / count(case when param = 'T2M' then value end)), 0) / 100 as mean_temperature,
       round_even(100 * coalesce(cast(sum(case when param = 'PRECTOTCORR' then exact end) as double), 0), 0) / 100 as total_rain
from wide group by site_id""")
def window_totals(spark, sf_dir):
    obs = select_window(v.observations(spark, sf_dir), start=START, end=END)
    return profile.window_totals(obs, ["site_id"], mean="T2M", total="PRECTOTCORR").withColumnsRenamed(
        {"mean": "mean_temperature", "total": "total_rain"})


@query("profile", f"""
with w as (select site_id, obs_date, {WIDE} from v_obs group by site_id, obs_date)
select cast(min(obs_date) as timestamp) as start_ts, cast(max(obs_date) as timestamp) as end_ts, count(*) as data_points,
       cast({' + '.join(f'count(*) filter (where "{p}" is null)' for p in PARAMS)} as bigint) as missing_values,
       cast(count(*) * {len(PARAMS)} as bigint) as total_cells, '{", ".join(PARAMS)}' as parameters from w""")
def profile_query(spark, sf_dir):
    wide = points.to_wide(v.observations(spark, sf_dir), ["site_id", "obs_ts"], PARAMS)
    return profile.profile_wide(wide, PARAMS)


@query("profile_by_param", """
select param, cast(min(obs_date) as timestamp) as start_ts, cast(max(obs_date) as timestamp) as end_ts,
       count(*) as data_points, count(*) filter (where value is null) as missing_values from v_obs group by param""")
def profile_by_param(spark, sf_dir):
    return profile.profile_by_param(v.observations(spark, sf_dir))


@query("describe_params", """
select param, count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, min(value) as min,
       round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
       round(quantile_cont(value, 0.75), 6) as q75, max(value) as max from v_obs group by param""")
def describe_params(spark, sf_dir):
    d = profile.describe_params(v.observations(spark, sf_dir))
    return d.select("param", "n", r6("mean"), r6("std"), "min", r6("q25"), r6("q50"), r6("q75"), "max")


@query("gdd", """
select site_id, cast(obs_date as timestamp) as obs_ts, value as t2m,
       case when value is not null then round(greatest(value - 10, 0), 6) end as gdd
from v_obs where param = 'T2M'""")
def gdd(spark, sf_dir):
    obs = select_window(v.observations(spark, sf_dir), params=["T2M"])
    return obs.select("site_id", "obs_ts", F.col("value").alias("t2m"),
                      F.round(profile.growing_degree_days(F.col("value")), 6).alias("gdd"))


@query("rate_audit", """
select event_id, user_id, ts, count(*) over w as calls_in_window, count(*) over w > 30 as over_limit
from events window w as (partition by user_id order by epoch_us(ts) range between 86399999999 preceding and current row)""")
def rate_audit(spark, sf_dir):
    log = v.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return profile.rate_audit(log, "user_id", "ts", calls=30, seconds=86400)


# --- requests ---------------------------------------------------------------------------

@query("validate_requests", """
select request_id,
       concat_ws('; ', case when params_csv = '' then 'no parameters' end,
                 case when temporal = 'hourly' and params_csv like '%GWETTOP%'
                      then 'daily-only parameter on hourly request: GWETTOP' end,
                 case when order_date > end_o then 'start after end' end,
                 case when wind_elevation < 10 or wind_elevation > 300 then 'wind elevation outside [10, 300]' end) as violations,
       concat_ws('; ', case when params_csv like '%FOO%' then 'unknown parameter: FOO' end,
                 case when temporal = 'hourly' and order_date < date '2001-01-01' then 'starts before the data does'
                      when temporal = 'daily' and order_date < date '1981-01-01' then 'starts before the data does' end) as warnings
from (select *, order_date + cast(end_date - start_date as int) as end_o from v_requests) r""")
def validate_requests(spark, sf_dir):
    asked = v.requests(spark, sf_dir).withColumn("last_date", F.date_add("order_date", F.date_diff("end_date", "start_date")))
    checked = req.validate_requests(asked, start="order_date", end="last_date")
    return checked.select("request_id", F.array_join("violations", "; ").alias("violations"),
                          F.array_join("warnings", "; ").alias("warnings"))


@query("validate_regions", """
select region_id, concat_ws('; ', case when not lat_min < lat_max then 'lat_min not below lat_max' end,
       case when not lon_min < lon_max then 'lon_min not below lon_max' end,
       case when lat_min < -90 or lat_max > 90 or lat_min > 90 or lat_max < -90 or lon_min < -180 or lon_max > 180
            then 'box outside the globe' end,
       case when lat_max - lat_min > 4.5 or lon_max - lon_min > 4.5 then 'box wider than 4.5 degrees' end) as violations
from v_regions""")
def validate_regions(spark, sf_dir):
    checked = req.validate_regions(v.view(spark, sf_dir, "v_regions"))
    return checked.select("region_id", F.array_join("violations", "; ").alias("violations"))


@query("validate_region_requests", """
with asked as (
  select *, case when region_id % 3 = 0 then 'hourly' else 'daily' end as temporal, case region_id % 4 when 0 then '' when 1 then 'T2M' when 2 then 'T2M,GWETTOP' else 'FOO' end as p,
         date '2024-01-10' as s, date '2024-01-10' + cast(region_id % 5 - 1 as int) as e from v_regions)
select region_id, concat_ws('; ', case when not lat_min < lat_max then 'lat_min not below lat_max' end,
       case when not lon_min < lon_max then 'lon_min not below lon_max' end,
       case when lat_min < -90 or lat_max > 90 or lat_min > 90 or lat_max < -90 or lon_min < -180 or lon_max > 180 then 'box outside the globe' end,
       case when lat_max - lat_min > 4.5 or lon_max - lon_min > 4.5 then 'box wider than 4.5 degrees' end,
       case when p = '' then 'no parameters' end,
       case when temporal = 'hourly' and p like '%GWETTOP%' then 'daily-only parameter on hourly request: GWETTOP' end,
       case when s > e then 'start after end' end, case when temporal = 'hourly' then 'no hourly regional data' end,
       case when p like '%,%' then 'more than 1 parameter' end) as violations,
       case when p = 'FOO' then 'unknown parameter: FOO' else '' end as warnings
from asked""")
def validate_region_requests(spark, sf_dir):
    k, day = F.col("region_id"), F.lit("2024-01-10").cast("date")
    names = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("T2M")).when(k % 4 == 2, F.lit("T2M,GWETTOP")).otherwise(F.lit("FOO"))
    asked = v.view(spark, sf_dir, "v_regions").withColumns({
        "temporal": F.when(k % 3 == 0, F.lit("hourly")).otherwise(F.lit("daily")), "params": F.filter(F.split(names, ","), lambda p: p != ""),
        "start_date": day, "end_date": F.date_add(day, (k % 5 - 1).cast("int"))})
    checked = req.validate_regions(asked, "params", "temporal", "start_date", "end_date")
    return checked.select("region_id", F.array_join("violations", "; ").alias("violations"), F.array_join("warnings", "; ").alias("warnings"))


@query("validate_limits", """
select c_custkey as request_id, concat_ws('; ',
       case when c_custkey % 24 + 1 > case when c_custkey % 2 = 0 then 15 else 20 end
            then 'more than ' || case when c_custkey % 2 = 0 then 15 else 20 end || ' parameters' end,
       case when c_custkey % 5 * 100 not between 10 and 300 then 'wind elevation outside [10, 300]' end) as violations
from customer""")
def validate_limits(spark, sf_dir):
    k = F.col("c_custkey")
    asked = v.table(spark, sf_dir, "customer").select(
        k.alias("request_id"), F.transform(F.sequence(F.lit(1), (k % 24 + 1).cast("int")), lambda i: F.concat(F.lit("P"), i)).alias("params"),
        F.when(k % 2 == 0, F.lit("hourly")).otherwise(F.lit("daily")).alias("temporal"),
        F.lit("2024-01-01").cast("date").alias("start_date"), F.lit("2024-01-02").cast("date").alias("end_date"),
        (k % 5 * 100).cast("double").alias("wind_elevation"))
    return req.validate_requests(asked).select("request_id", F.array_join("violations", "; ").alias("violations"))


@query("request_key", r"""
select request_id, 'v1_' || sha256(concat_ws('|', temporal, params_csv, lat::varchar, lon::varchar,
       coalesce(elevation::varchar, '\N'), coalesce(wind_elevation::varchar, '\N'), '\N')) as request_key
from v_requests r join v_points p on p.site_id = r.site_id""")
def request_key(spark, sf_dir):
    sites = v.view(spark, sf_dir, "v_points").select("site_id", "lat", "lon", "elevation")
    asked = v.requests(spark, sf_dir).join(sites, "site_id")
    return asked.select("request_id", req.request_key(
        F.col("params"), F.col("temporal"), F.col("lat"), F.col("lon"), F.col("elevation"), F.col("wind_elevation"),
        F.lit(None).cast("string")).alias("request_key"))


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per parameter with their missing ranges."""
    per_param = v.requests(spark, sf_dir).withColumn("param", F.explode("params"))
    hours = select_window(v.hourly_observations(spark, sf_dir), start="2024-01-05", end="2024-01-20", end_of_day=True)
    keys = ["site_id", "param", "temporal"]
    held = coverage(_held(spark, sf_dir).withColumn("temporal", F.lit("daily"))
                    .unionByName(hours.withColumn("temporal", F.lit("hourly"))), keys)
    return req.missing_ranges(per_param, held, keys)


PLAN = """
per_param as (select r.*, unnest(string_split(params_csv, ',')) as param from v_requests r where params_csv <> ''),
held as (select 'daily' as temporal, site_id, param, cast(min(obs_date) as timestamp) as lo, cast(max(obs_date) as timestamp) as hi
         from v_held group by site_id, param
         union all select 'hourly', site_id, param, min(hr), max(hr) from v_hourly
         where cast(hr as date) between date '2024-01-05' and date '2024-01-20' group by site_id, param),
asked as (select p.*, lo, hi, cast(start_date as timestamp) as s,
                 cast(end_date as timestamp) + case when p.temporal = 'hourly' then interval 23 hour else interval 0 hour end as e,
                 case when p.temporal = 'hourly' then interval 1 hour else interval 24 hour end as step
          from per_param p left join held h on h.site_id = p.site_id and h.param = p.param and h.temporal = p.temporal),
pieces as (select request_id, site_id, param, temporal, 0 as edge, s as range_start, e as range_end from asked where lo is null
           union all select request_id, site_id, param, temporal, 1, s, lo - step from asked where s < lo
           union all select request_id, site_id, param, temporal, 2, hi + step, e from asked where e > hi)"""
PLAN_ROWS = """
select request_id, site_id, param, cast(row_number() over (partition by request_id, param order by edge) as int) as range_no,
       range_start, range_end, strftime(range_start, '%Y%m%d') as start_key, strftime(range_end, '%Y%m%d') as end_key
from pieces"""


def _plan_rows(planned: DataFrame) -> DataFrame:
    return req.fetch_plan(planned).select("request_id", "site_id", "param", "range_no", "range_start", "range_end",
                                          "start_key", "end_key")


@query("fetch_plan", f"with {PLAN} {PLAN_ROWS} where temporal = 'daily'")
def fetch_plan(spark, sf_dir):
    return _plan_rows(_planned(spark, sf_dir).where("temporal = 'daily'"))


@query("fetch_plan_hourly", f"with {PLAN} {PLAN_ROWS} where temporal = 'hourly'")
def fetch_plan_hourly(spark, sf_dir):
    return _plan_rows(_planned(spark, sf_dir).where("temporal = 'hourly'"))


@query("fetch_payloads", f"""
with {PLAN}, codes as (select distinct request_id, site_id, temporal, range_start, range_end, param from pieces),
numbered as (select *, row_number() over (partition by request_id, site_id, temporal, range_start, range_end order by param) - 1 as i from codes)
select request_id, site_id, temporal, range_start, range_end, cast(i // case when temporal = 'hourly' then 15 else 20 end + 1 as int) as chunk_no,
       string_agg(param, ',' order by param) as params from numbered group by all""")
def fetch_payloads(spark, sf_dir):
    calls = req.fetch_payloads(req.fetch_plan(_planned(spark, sf_dir)), ["request_id", "site_id"])
    return calls.withColumn("params", F.array_join("params", ","))


@query("plan_hit_rate", f"""
with {PLAN}, n as (select a.request_id, a.param, count(p.edge) as k from asked a
  left join pieces p on p.request_id = a.request_id and p.param = a.param group by all)
select count(*) as total_requests, count(*) filter (where k = 0) as store_hits, cast(sum(k) as bigint) as ranges_to_fetch,
       round(count(*) filter (where k = 0) * 100.0::double / count(*), 1) as hit_rate_pct from n""")
def plan_hit_rate(spark, sf_dir):
    return req.plan_hit_rate(_planned(spark, sf_dir))


@query("stale_fallback", f"""
with {PLAN}, n as (select a.request_id, a.site_id, a.param, a.lo, a.fetch_status, count(p.edge) as k from asked a
  left join pieces p on p.request_id = a.request_id and p.param = a.param group by all)
select request_id, site_id, param, fetch_status,
       case when k = 0 then 'store' when fetch_status = 'ok' then 'fresh' when fetch_status = 'HTTP 422' then 'error'
            when lo is not null then 'stale' else 'error' end as served_from from n""")
def stale_fallback(spark, sf_dir):
    return req.served_from(_planned(spark, sf_dir)).select("request_id", "site_id", "param", "fetch_status", "served_from")


HISTORY = """
history as (select 'daily' as temporal, site_id, param, cast(obs_date as timestamp) as ts, value from v_held
            union all select 'hourly', site_id, param, hr, value from v_hourly where cast(hr as date) between date '2024-01-05' and date '2024-01-20')"""


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held rows of both resolutions."""
    hours = select_window(v.hourly_observations(spark, sf_dir), start="2024-01-05", end="2024-01-20", end_of_day=True)
    columns = ["site_id", "param", "obs_ts", "value"]
    return _held(spark, sf_dir).select(*columns, F.lit("daily").alias("temporal")).unionByName(hours.select(*columns, F.lit("hourly").alias("temporal")))


@query("stale_rows", f"""
with {PLAN}, {HISTORY}, n as (select a.request_id, a.site_id, a.param, a.temporal, a.lo, a.s, a.e, a.fetch_status, count(p.edge) as k from asked a
  left join pieces p on p.request_id = a.request_id and p.param = a.param group by all)
select request_id, n.site_id, n.param, n.temporal, ts as obs_ts, value from n join history h
  on h.site_id = n.site_id and h.param = n.param and h.temporal = n.temporal and h.ts between n.s and n.e
where k > 0 and fetch_status not in ('ok', 'HTTP 422') and lo is not null""")
def stale_rows(spark, sf_dir):
    served = req.served_from(_planned(spark, sf_dir))
    return req.stale_rows(served, _history(spark, sf_dir), ["site_id", "param", "temporal"]).select(
        "request_id", "site_id", "param", "temporal", "obs_ts", "value")


@query("fetch_plan_holes", f"""
with {PLAN}, {HISTORY}, spaced as (
  select *, lag(ts) over (partition by temporal, site_id, param order by ts) as prev,
         case when temporal = 'hourly' then interval 1 hour else interval 24 hour end as gap from history),
ranges as (
  select request_id, site_id, param, temporal, s as range_start, e as range_end from asked where lo is null and s <= e
  union all select request_id, site_id, param, temporal, s, least(e, lo - step) from asked where s < lo and s <= e
  union all select request_id, site_id, param, temporal, greatest(s, hi + step), e from asked where e > hi and s <= e
  union all select request_id, a.site_id, a.param, a.temporal, greatest(s, prev + gap), least(e, ts - gap)
    from asked a join spaced h on h.site_id = a.site_id and h.param = a.param and h.temporal = a.temporal
    where ts - prev > gap and prev + gap <= e and ts - gap >= s and s <= e)
select *, strftime(range_start, '%Y%m%d') as start_key, strftime(range_end, '%Y%m%d') as end_key from ranges""")
def fetch_plan_holes(spark, sf_dir):
    per_param = v.requests(spark, sf_dir).withColumn("param", F.explode("params"))
    return req.fetch_holes(per_param, _history(spark, sf_dir), ["site_id", "param", "temporal"]).select(
        "request_id", "site_id", "param", "temporal", "range_start", "range_end", "start_key", "end_key")


FAILED = f"""{PLAN}, n as (select a.request_id, a.param, a.lo, a.fetch_status, count(p.edge) as k from asked a
  left join pieces p on p.request_id = a.request_id and p.param = a.param group by all),
served as (select distinct request_id from n
           where k = 0 or fetch_status = 'ok' or (fetch_status <> 'HTTP 422' and lo is not null)),
failures as (select r.request_id, r.site_id,
       case when params_csv = '' then 'no parameters' when fetch_status <> 'ok' then fetch_status else 'no data returned' end as reason
  from v_requests r where request_id not in (select request_id from served))"""


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = v.requests(spark, sf_dir)
    served = req.served_from(_planned(spark, sf_dir)).where("served_from <> 'error'")
    empty = F.when(F.size("params") == 0, F.lit("no parameters"))
    failed = F.when(F.col("fetch_status") != "ok", F.col("fetch_status"))
    reasons = asked.select("request_id", F.coalesce(empty, failed).alias("reason"))
    return req.failed_points(asked.select("request_id", "site_id"), served, reasons, ["request_id"]).select(
        "request_id", "site_id", "reason")


@query("failed_points", f"with {FAILED} select * from failures")
def failed_points(spark, sf_dir):
    return _failures(spark, sf_dir)


@query("failure_sample", f"""
with {FAILED}, head as (select * from failures order by request_id limit 5),
msgs as (select reason, min(request_id) as first_id from (select * from head order by request_id limit 3) h group by reason)
select (select count(*) from failures) as failed_count,
       (select string_agg(request_id || ': ' || reason, '; ' order by request_id) from head) as shown,
       greatest((select count(*) from failures) - 5, 0) as more_count,
       (select string_agg(reason, ', ' order by first_id) from msgs) as messages""")
def failure_sample(spark, sf_dir):
    return req.failure_sample(_failures(spark, sf_dir), "request_id")


# --- coordinates and dates ----------------------------------------------------------------

@query("sites_standardise", """
select site_id, round(case when lat_expected is not null and ok then lat_expected end, 9) + 0 as lat,
       case when lat_expected is not null and ok then lon_expected end as lon,
       case when style = 1 then 'number' when style = 0 then 'dd,dd' when style = 2 then 'ddm,dd'
            when style in (3, 4, 5, 6) then 'dms,dd' end as coord_format,
       case when style = 6 and site_id % 89 <> 0 then 'minus sign ignored, hemisphere letter used' end as coord_warning,
       case when style = 7 then 'cannot read latitude' when not ok then 'longitude outside [-180, 180]' end as coord_error
from (select *, lon_expected <= 180 as ok from v_coord_text) t""")
def sites_standardise(spark, sf_dir):
    text = v.view(spark, sf_dir, "v_coord_text").select(
        "site_id", F.col("lat_text").alias("lat"), F.col("lon_text").alias("lon"))
    return coord.standardise_sites(text).select("site_id", (F.round("lat", 9) + 0.0).alias("lat"), "lon",
                                                "coord_format", "coord_warning", "coord_error")


def _parsed(spark: SparkSession, sf_dir: str, notation: str) -> DataFrame:
    text = v.view(spark, sf_dir, "v_coord_text").select("site_id", "lat_text")
    return coord.parse_column(text, "lat_text", True, "lat", (notation,)).select(
        "site_id", (F.round("lat", 9) + 0.0).alias("lat"), F.col("lat_clash").alias("sign_clash"))


def _parse_twin(styles: str) -> str:
    return (f"select site_id, case when style in ({styles}) then round(lat_expected, 9) + 0 end as lat,"
            f" style in ({styles}) and style = 6 and try_cast(split_part(substr(lat_text, 2), chr(176), 1) as int) > 0"
            " as sign_clash from v_coord_text")


@query("parse_dd", _parse_twin("0, 1"))
def parse_dd(spark, sf_dir):
    return _parsed(spark, sf_dir, "dd")


@query("parse_ddm", _parse_twin("2"))
def parse_ddm(spark, sf_dir):
    return _parsed(spark, sf_dir, "ddm")


@query("parse_dms", _parse_twin("3, 4, 5, 6"))
def parse_dms(spark, sf_dir):
    return _parsed(spark, sf_dir, "dms")


HEM_LAT = "case when lat >= 0 then 'N' else 'S' end"
HEM_LON = "case when lon >= 0 then 'E' else 'W' end"


@query("format_dd", f"""
select site_id, format('{{:.5f}}', abs(lat)) || '° ' || {HEM_LAT} as lat_text,
       format('{{:.5f}}', abs(lon)) || '° ' || {HEM_LON} as lon_text from v_points""")
def format_dd(spark, sf_dir):
    return v.view(spark, sf_dir, "v_points").select(
        "site_id", coord.format_dd("lat", True).alias("lat_text"), coord.format_dd("lon", False).alias("lon_text"))


@query("format_ddm", f"""
select site_id,
       cast(floor(abs(lat)) as bigint) || '°' || format('{{:.3f}}', (abs(lat) - floor(abs(lat))) * 60e0) || chr(39) || ' ' || {HEM_LAT} as lat_text,
       cast(floor(abs(lon)) as bigint) || '°' || format('{{:.3f}}', (abs(lon) - floor(abs(lon))) * 60e0) || chr(39) || ' ' || {HEM_LON} as lon_text
from v_points""")
def format_ddm(spark, sf_dir):
    return v.view(spark, sf_dir, "v_points").select(
        "site_id", coord.format_ddm("lat", True).alias("lat_text"), coord.format_ddm("lon", False).alias("lon_text"))


def _dms_twin(c: str, hem: str) -> str:
    minutes = f"((abs({c}) - floor(abs({c}))) * 60e0)"
    return (f"cast(floor(abs({c})) as bigint) || '°' || cast(floor({minutes}) as bigint) || chr(39)"
            f" || format('{{:.0f}}', ({minutes} - floor({minutes})) * 60e0) || chr(34) || ' ' || {hem}")


@query("format_dms", f"select site_id, {_dms_twin('lat', HEM_LAT)} as lat_text, {_dms_twin('lon', HEM_LON)} as lon_text from v_points")
def format_dms(spark, sf_dir):
    return v.view(spark, sf_dir, "v_points").select(
        "site_id", coord.format_dms("lat", True).alias("lat_text"), coord.format_dms("lon", False).alias("lon_text"))


DATE_TEXTS = ["yyyy-MM-dd", "yyyyMMdd", "dd/MM/yyyy", "'on' yyyy"]


def _date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    text = F.date_format("o_orderdate", DATE_TEXTS[3])
    for i in (2, 1, 0):
        text = F.when(kind == i, F.date_format("o_orderdate", DATE_TEXTS[i])).otherwise(text)
    return v.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("date_text"))


@query("parse_dates", """
select o_orderkey, case when o_orderkey % 4 < 2 then o_orderdate end as "date",
       case o_orderkey % 4 when 2 then 'ambiguous date' when 3 then 'unreadable date' end as date_error from orders""")
def parse_dates_query(spark, sf_dir):
    return parse_dates(_date_texts(spark, sf_dir), "date_text").select("o_orderkey", "date", "date_error")


@query("ensure_date", "select event_id, date_trunc('second', ts)::timestamp as \"date\" from events")
def ensure_date(spark, sf_dir):
    text = v.table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"))
    return ensure_date_column(text)


@query("ensure_date_candidates", "select o_orderkey, o_totalprice, o_orderdate as \"date\" from orders")
def ensure_date_candidates(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate"))
    return ensure_date_column(orders, candidates=["obs_date", "o_orderdate"])


@query("ensure_date_normalize", "select event_id, cast(cast(ts as date) as timestamp) as \"date\" from events")
def ensure_date_normalize(spark, sf_dir):
    zoned = v.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("measured_at"))
    return ensure_date_column(zoned, candidates=["measured_at"], normalize=True)


# --- transects and regions ------------------------------------------------------------------

COUNTED = """
sized as (select *, case when params_csv like 'ALLSKY%' then 1.0e0 else 0.5e0 end * 111.1e0 as step_km,
       sqrt(power((lat2 - lat1) * 111.1e0, 2) + power((lon2 - lon1) * 111.32e0 * cos(radians((lat1 + lat2) / 2)), 2)) as total_km
  from v_transects),
asked as (select *, coalesce(num_points::double, greatest(2, round_even(total_km / spacing_km, 0) + 1)) as want from sized),
counted as (select *, cast(greatest(2, case when want > 1 and total_km / (want - 1) < step_km
       then greatest(2, floor(total_km / step_km) + 1) else want end) as int) as n_points from asked)"""
SAMPLED = COUNTED + """,
numbered as (select *, unnest(range(n_points)) as i from counted),
sampled as (select transect_id, cast(i + 1 as int) as point_no, params_csv, 'Point_' || (i + 1) as name,
       round_even(10000e0 * case when i = n_points - 1 then lat2 else lat1 + i * ((lat2 - lat1) / (n_points - 1)) end, 0) / 10000 + 0 as lat,
       round_even(10000e0 * case when i = n_points - 1 then lon2 else lon1 + i * ((lon2 - lon1) / (n_points - 1)) end, 0) / 10000 + 0 as lon
  from numbered)"""


@query("transect_count", f"with {COUNTED} select transect_id, round(total_km, 6) as total_km, n_points from counted")
def transect_count(spark, sf_dir):
    return transects.transect_counts(v.transects(spark, sf_dir)).select("transect_id", r6("total_km"), "n_points")


@query("transect_points", f"with {SAMPLED} select transect_id, point_no, lat, lon, name from sampled")
def transect_points(spark, sf_dir):
    return transects.transect_points(transects.transect_counts(v.transects(spark, sf_dir))).drop("params")


@query("transect_query", f"""
with {SAMPLED}, placed as (select *, unnest(string_split(params_csv, ',')) as param from sampled),
celled as (select *, case when param like 'ALLSKY%' then least(floor(lat + 90), 179) else floor((lat + 90) / 0.5e0 + 0.5e0) end as cell_lat,
       case when param like 'ALLSKY%' then cast(floor(lon + 180) as bigint) % 360
            else cast(floor((lon + 180) / 0.625e0 + 0.5e0) as bigint) % 576 end as cell_lon from placed)
select transect_id, point_no, lat, lon, name, c.param, cast(obs_date as timestamp) as obs_ts, value
from celled c join v_store o on o.param = c.param and o.cell_lat = c.cell_lat and o.cell_lon = c.cell_lon
where {WINDOW}""")
def transect_query(spark, sf_dir):
    return transects.transect_query(v.store(spark, sf_dir), v.transects(spark, sf_dir), START, END,
                                    params=["T2M", "RH2M", "ALLSKY_SFC_SW_DWN"])


REGION_ROWS = f"""
valid as (select * from v_regions where lat_min < lat_max and lon_min < lon_max and lat_max - lat_min <= 4.5
          and lon_max - lon_min <= 4.5 and lat_min >= -90 and lat_max <= 90 and lon_min >= -180 and lon_max <= 180),
cells as (select *, case when param like 'ALLSKY%' then cell_lat + 0.5e0 - 90 else cell_lat * 0.5e0 - 90 end as lat,
                 case when param like 'ALLSKY%' then cell_lon + 0.5e0 - 180 else cell_lon * 0.625e0 - 180 end as lon
          from v_store where {WINDOW}),
answer as (select region_id, v.param, cast(obs_date as timestamp) as obs_ts, lat, lon, value
  from valid v join cells c on c.param = v.param and c.lat between v.lat_min and v.lat_max
    and c.lon between v.lon_min and v.lon_max)"""


@query("region_query", f"with {REGION_ROWS} select * from answer")
def region_query(spark, sf_dir):
    return regions.region_query(v.store(spark, sf_dir), v.view(spark, sf_dir, "v_regions"), START, END,
                                params=["T2M", "ALLSKY_SFC_SW_DWN"])


@query("union_regions", f"""
with {REGION_ROWS} select region_id, obs_ts, lat, lon, case when param = 'T2M' then value end as "T2M",
  case when param <> 'T2M' then value end as "ALLSKY_SFC_SW_DWN" from answer""")
def union_regions(spark, sf_dir):
    held, boxes = v.store(spark, sf_dir), v.view(spark, sf_dir, "v_regions")
    asked = ["T2M", "ALLSKY_SFC_SW_DWN"]
    answer = regions.region_query(held, boxes, START, END, params=asked)
    # one frame a parameter, each with a column of its own
    frames = [answer.where(F.col("param") == p).select("region_id", "obs_ts", "lat", "lon", F.col("value").alias(p)) for p in asked]
    return merge.union_columns(*frames)


WRAPPED = """
boxes as (select n_nationkey * 1000000 + c_custkey % 1000 as box, case when c_custkey % 2 = 0 then 'T2M' else 'ALLSKY_SFC_SW_DWN' end as param,
                 min(lat) - 1.5e0 as lat_min, min(lat) + 1.5e0 as lat_max, 177e0 + n_nationkey % 4 as lon_min, -179e0 + n_nationkey % 3 as lon_max
          from customer join nation on n_nationkey = c_nationkey join v_points on site_id = c_custkey group by all),
valid as (select * from boxes where lat_min >= -90 and lat_max <= 90 and lon_max + 360 - lon_min <= 4.5 and lon_min <= 180),
cells as (select *, case when param like 'ALLSKY%' then cell_lat + 0.5e0 - 90 else cell_lat * 0.5e0 - 90 end as lat,
                 case when param like 'ALLSKY%' then cell_lon + 0.5e0 - 180 else cell_lon * 0.625e0 - 180 end as lon
          from v_store)
select box as region_id, v.param, cast(obs_date as timestamp) as obs_ts, lat, lon, value
from valid v join cells c on c.param = v.param and c.lat between v.lat_min and v.lat_max and (c.lon >= v.lon_min or c.lon <= v.lon_max)"""


def _wrapped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes across the antimeridian at the latitudes of customers, by nation."""
    nation, k = F.col("n_nationkey"), F.col("c_custkey")
    rows = v.table(spark, sf_dir, "customer").join(v.table(spark, sf_dir, "nation"), F.col("c_nationkey") == nation).join(
        v.view(spark, sf_dir, "v_points").select("site_id", "lat"), F.col("site_id") == k)
    return rows.groupBy((nation * 1000000 + k % 1000).alias("region_id"), F.when(k % 2 == 0, "T2M").otherwise("ALLSKY_SFC_SW_DWN").alias("param"),
                        (177.0 + nation % 4).alias("lon_min"), (-179.0 + nation % 3).alias("lon_max")).agg(F.min("lat").alias("_lat")).select(
        "region_id", "param", (F.col("_lat") - 1.5).alias("lat_min"), (F.col("_lat") + 1.5).alias("lat_max"), "lon_min", "lon_max")


@query("region_wrapped", f"with {WRAPPED}")
def region_wrapped(spark, sf_dir):
    return regions.region_query(v.store(spark, sf_dir), _wrapped_boxes(spark, sf_dir), "2024-01-01", "2024-12-31", wrap=True,
                                params=["T2M", "ALLSKY_SFC_SW_DWN"])


@query("region_tiled", f"""
with boxes as (select site_id as region_id, case when site_id % 2 = 0 then 'T2M' else 'ALLSKY_SFC_SW_DWN' end as param, lat - 1.75e0 as lat_min,
                      least(lat + 7e0, 90e0) as lat_max, lon as lon_min, case when lon + 11e0 > 180 then lon + 11e0 - 360 else lon + 11e0 end as lon_max from v_points),
cells as (select *, case when param like 'ALLSKY%' then cell_lat + 0.5e0 - 90 else cell_lat * 0.5e0 - 90 end as lat,
                 case when param like 'ALLSKY%' then cell_lon + 0.5e0 - 180 else cell_lon * 0.625e0 - 180 end as lon
          from v_store where {{WINDOW}})
select region_id, b.param, cast(obs_date as timestamp) as obs_ts, c.lat, c.lon, value
from boxes b join cells c on c.param = b.param and c.lat between b.lat_min and b.lat_max
  and case when b.lon_min <= b.lon_max then c.lon between b.lon_min and b.lon_max else c.lon >= b.lon_min or c.lon <= b.lon_max end
where b.lat_min >= -90""".replace("{WINDOW}", WINDOW))
def region_tiled(spark, sf_dir):
    east = F.col("lon") + 11.0
    boxes = v.view(spark, sf_dir, "v_points").select(
        F.col("site_id").alias("region_id"), F.when(F.col("site_id") % 2 == 0, "T2M").otherwise("ALLSKY_SFC_SW_DWN").alias("param"),
        (F.col("lat") - 1.75).alias("lat_min"), F.least(F.col("lat") + 7.0, F.lit(90.0)).alias("lat_max"), F.col("lon").alias("lon_min"),
        F.when(east > 180, east - 360.0).otherwise(east).alias("lon_max")).where("lat_min >= -90")
    return regions.tiled_rows(v.store(spark, sf_dir), regions.tile_boxes(boxes, wrap=True), START, END, params=["T2M", "ALLSKY_SFC_SW_DWN"])


# --- streaming ------------------------------------------------------------------------------

@query("store_append", """
with placed as (
  select o.*, case when param like 'ALLSKY%' then least(floor(lat + 90), 179) else least(floor((lat + 90) / 0.5e0 + 0.5e0), 360) end as la,
         case when param like 'ALLSKY%' then cast(floor(lon + 180) as bigint) % 360
              else cast(floor((lon + 180) / 0.625e0 + 0.5e0) as bigint) % 576 end as lo
  from v_obs_raw o join v_points p on p.site_id = o.site_id)
select param, cast(la as int) as cell_lat, cast(lo as int) as cell_lon, cast(obs_date as timestamp) as obs_ts,
       nullif(arg_min_null(raw_value, (seq % 4) * 1000000000000 + seq), -999) as value
from placed group by all""")
def store_append(spark, sf_dir):
    return streams.appended_store(spark, sf_dir).read().select("param", "cell_lat", "cell_lon", "obs_ts", "value")


@query("store_append_stats", """
select count(distinct (param, cell_lat, cell_lon)) as entries, count(*) as row_count,
       cast(min(obs_date) as timestamp) as oldest, cast(max(obs_date) as timestamp) as newest from v_store""")
def store_append_stats(spark, sf_dir):
    return streams.appended_store(spark, sf_dir).stats().select("entries", "row_count", "oldest", "newest")


@query("coverage_incremental", """
select param, cell_lat, cell_lon, cast(min(obs_date) as timestamp) as held_min, cast(max(obs_date) as timestamp) as held_max,
       count(*) as held_rows from v_store group by param, cell_lat, cell_lon""")
def coverage_incremental(spark, sf_dir):
    store = streams.appended_store(spark, sf_dir, turns=2)
    store.fold()
    streams.append_quarters(spark, sf_dir, store, streams.BATCHES[2:])  # deltas after the fold
    return store.coverage().select("param", "cell_lat", "cell_lon", "held_min", "held_max", "held_rows")


@query("store_compact", """
with placed as (
  select o.*, case when param like 'ALLSKY%' then least(floor(lat + 90), 179) else least(floor((lat + 90) / 0.5e0 + 0.5e0), 360) end as la,
         case when param like 'ALLSKY%' then cast(floor(lon + 180) as bigint) % 360
              else cast(floor((lon + 180) / 0.625e0 + 0.5e0) as bigint) % 576 end as lo
  from v_obs_raw o join v_points p on p.site_id = o.site_id)
select param, cast(la as int) as cell_lat, cast(lo as int) as cell_lon, cast(obs_date as timestamp) as obs_ts,
       nullif(arg_min_null(raw_value, (seq % 4) * 1000000000000 + seq), -999) as value
from placed group by all""")
def store_compact(spark, sf_dir):
    store = streams.appended_store(spark, sf_dir, turns=2)
    store.compact()
    streams.append_quarters(spark, sf_dir, store, streams.BATCHES[2:])  # appends go on after it
    store.compact()
    return store.read().select("param", "cell_lat", "cell_lon", "obs_ts", "value")


@query("multi_point_stored", f"""
select site_id, lat, lon, name, elevation, cast(obs_date as timestamp) as obs_ts, {WIDE}
from v_site_cells s join v_store o using (param, cell_lat, cell_lon)
where {WINDOW} and param in ({', '.join(repr(p) for p in PARAMS)}) group by all""")
def multi_point_stored(spark, sf_dir):
    sites = v.view(spark, sf_dir, "v_points")
    tiles = points.site_tiles(sites, PARAMS)
    held = streams.stored_observations(spark, sf_dir).read("daily", PARAMS, START, END, tiles=tiles)
    return points.multi_point(held, sites, START, END, PARAMS, match_variant=False, tiles=tiles)


@query("multi_point_manifest", f"""
select site_id, lat, lon, name, s.elevation, cast(obs_date as timestamp) as obs_ts, {WIDE}
from v_site_cells s join v_store_adjusted o
  on s.param = o.param and s.cell_lat = o.cell_lat and s.cell_lon = o.cell_lon and s.elevation is not distinct from o.elevation
where {WINDOW} and s.param in ({', '.join(repr(p) for p in PARAMS)}) group by all""".replace("case when param", "case when s.param"))
def multi_point_manifest(spark, sf_dir):
    held = streams.ingest_requests(spark, sf_dir).read("daily", PARAMS, START, END)
    return points.multi_point(held, v.view(spark, sf_dir, "v_points"), START, END, PARAMS)


@query("stream_rejects", """
select seq as response_id, case when seq % 6 = 3 then param end as param, case when seq % 6 = 3 then strftime(obs_date, '%Y%m%d') end as date_key,
       case seq % 6 when 1 then 'HTTP 422' when 2 then 'HTTP 500' else 'date key of another resolution' end as reason
from v_obs_raw join v_points using (site_id) where seq % 6 in (1, 2, 3)""")
def stream_rejects(spark, sf_dir):
    return streams.refused_requests(spark, sf_dir)


@query("stream_ingest", """
select param, cell_lat, cell_lon, cast(obs_date as timestamp) as obs_ts, value from v_store""")
def stream_ingest(spark, sf_dir):
    return streams.ingest_events(spark, sf_dir).select("param", "cell_lat", "cell_lon", "obs_ts", "value")


@query("stream_first_arrivals", """
select distinct site_id, param, cast(obs_date as timestamp) as obs_ts from v_obs_raw""")
def stream_first_arrivals(spark, sf_dir):
    return streams.first_arrivals(spark, sf_dir).select("site_id", "param", F.col("obs_date").cast("timestamp_ntz").alias("obs_ts"))
