"""Request tables: validation, keys and the fetch plan.

A bad request never stops the job: it gets a non-empty `violations` array and
`split_requests` moves it to the quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclimate.functions.dates import date_key
from gridclimate.sources.catalog import (
    ALL_GROUP, DAILY_ONLY, HOURLY_START, MAX_BOX_DEGREES, MAX_PARAMS_DAILY, MAX_PARAMS_HOURLY,
    MAX_PARAMS_REGIONAL, METEO_FAMILY, SOLAR, SOLAR_FAMILY, WIND_ELEVATION_RANGE)


def _codes(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _listed(text: str, codes: Column) -> Column:
    """Message naming the codes, NULL when there are none."""
    return F.when(F.size(codes) > 0, F.concat(F.lit(text + ": "), F.array_join(codes, ", ")))


def _request_checks(params: Column, temporal: Column, start: Column, end: Column) -> list[Column]:
    daily_only = F.array_intersect(params, _codes(DAILY_ONLY))
    return [
        F.when(F.size(params) == 0, F.lit("no parameters")),
        F.when(temporal == "hourly", _listed("daily-only parameter on hourly request", daily_only)),
        F.when(start > end, F.lit("start after end")),
        F.when(~temporal.isin("daily", "hourly") | temporal.isNull(), F.lit("unknown resolution")),
    ]


def _early_start(params: Column, temporal: Column, start: Column) -> Column:
    """Warning for a start before the first day the parameter family covers."""
    solar = F.arrays_overlap(params, _codes(SOLAR))
    meteo = F.size(F.array_except(params, _codes(SOLAR))) > 0
    day = start.cast("date")
    late = (F.when(temporal == "hourly", day < F.lit(HOURLY_START).cast("date"))
            .otherwise((solar & (day < F.lit(SOLAR_FAMILY[3]).cast("date")))
                       | (meteo & (day < F.lit(METEO_FAMILY[3]).cast("date")))))
    return F.when(late, F.lit("starts before the data does"))


def _with_findings(df: DataFrame, checks: list[Column], warnings: list[Column]) -> DataFrame:
    return df.withColumns({"violations": F.array_compact(F.array(*checks)),
                           "warnings": F.array_compact(F.array(*warnings))})


def validate_requests(df: DataFrame, params: str = "params", temporal: str = "temporal",
                      start: str = "start_date", end: str = "end_date",
                      wind_elevation: str | None = "wind_elevation") -> DataFrame:
    """Add `violations` and `warnings` arrays to point requests."""
    p, t, s, e = F.col(params), F.col(temporal), F.col(start), F.col(end)
    limit = F.when(t == "hourly", F.lit(MAX_PARAMS_HOURLY)).otherwise(F.lit(MAX_PARAMS_DAILY))
    checks = _request_checks(p, t, s, e)
    checks.append(F.when(F.size(p) > limit, F.concat(F.lit("more than "), limit.cast("string"), F.lit(" parameters"))))
    if wind_elevation and wind_elevation in df.columns:
        low, high = WIND_ELEVATION_RANGE
        checks.append(F.when(~F.col(wind_elevation).between(low, high),
                             F.lit(f"wind elevation outside [{low:g}, {high:g}]")))
    return _with_findings(df, checks, [_listed("unknown parameter", F.array_except(p, _codes(ALL_GROUP))),
                                       _early_start(p, t, s)])


def box_checks(enforce_span: bool = True, wrap: bool = False) -> list[Column]:
    """Violation messages for `lat_min, lat_max, lon_min, lon_max`.

    With `wrap`, `lon_min` above `lon_max` is a box across the antimeridian, not a mistake.
    """
    lat_min, lat_max, lon_min, lon_max = map(F.col, ("lat_min", "lat_max", "lon_min", "lon_max"))
    in_range = (lat_min.between(-90.0, 90.0) & lat_max.between(-90.0, 90.0)
                & lon_min.between(-180.0, 180.0) & lon_max.between(-180.0, 180.0))
    checks = [
        F.when(~(lat_min < lat_max), F.lit("lat_min not below lat_max")),
        F.when(lon_min == lon_max if wrap else ~(lon_min < lon_max), F.lit("lon_min not below lon_max")),
        F.when(~in_range, F.lit("box outside the globe")),
    ]
    if enforce_span:
        east = F.when(lon_min > lon_max, lon_max + 360.0).otherwise(lon_max) if wrap else lon_max
        checks.append(F.when((lat_max - lat_min > MAX_BOX_DEGREES) | (east - lon_min > MAX_BOX_DEGREES),
                             F.lit(f"box wider than {MAX_BOX_DEGREES:g} degrees")))
    return checks


def validate_regions(df: DataFrame, params: str | None = None, temporal: str | None = None,
                     start: str | None = None, end: str | None = None, enforce_span: bool = True,
                     wrap: bool = False) -> DataFrame:
    """Add `violations` and `warnings` to box requests; request columns are checked when named."""
    checks, warnings = box_checks(enforce_span, wrap), []
    if params:
        p = F.col(params)
        t = F.col(temporal) if temporal else F.lit("daily")
        checks += _request_checks(p, t, F.col(start), F.col(end))
        checks += [F.when(t == "hourly", F.lit("no hourly regional data")),
                   F.when(F.size(p) > MAX_PARAMS_REGIONAL, F.lit(f"more than {MAX_PARAMS_REGIONAL} parameter"))]
        warnings = [_listed("unknown parameter", F.array_except(p, _codes(ALL_GROUP))), _early_start(p, t, F.col(start))]
    if not warnings:
        return df.withColumn("violations", F.array_compact(F.array(*checks)))
    return _with_findings(df, checks, warnings)


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted requests and the quarantine."""
    return df.where(F.size("violations") == 0), df.where(F.size("violations") > 0)


def request_key(params: Column, temporal: Column, lat: Column, lon: Column, elevation: Column,
                wind_elevation: Column, wind_surface: Column) -> Column:
    """`v1_` and the SHA-256 of the request without its dates; parameter order matters.

    Numbers are written in full, so two places share a key only if they are one place, and
    an absent part has a mark that no text can equal.
    """
    def text(value: Column) -> Column:
        marked = value
        for sign in ("\\", "|", ","):
            marked = F.replace(marked, F.lit(sign), F.lit("\\" + sign))
        return F.coalesce(marked, F.lit("\\N"))

    def number(value: Column) -> Column:
        value = value.cast("double")
        return F.coalesce(F.when(value == 0, F.lit("0.0")).otherwise(value.cast("string")), F.lit("\\N"))  # no negative zero

    whole = F.concat_ws("|", text(temporal), F.coalesce(F.array_join(F.transform(params, text), ","), F.lit("\\N")), number(lat), number(lon),
                        number(elevation), number(wind_elevation), text(wind_surface))
    return F.concat(F.lit("v1_"), F.sha2(whole, 256))


# --- fetch plan -----------------------------------------------------------------------

def missing_ranges(requests: DataFrame, held: DataFrame, keys: list[str], temporal: str = "temporal",
                   start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Add `held_min`, `held_max` and `ranges`: what each request still has to fetch.

    `held` is one row per key (see `coverage`), so the join cannot multiply
    requests. Only the edges count: holes inside the held span are not refetched
    and a disjoint request is bridged. The service takes days, so a time of day is
    cut off both bounds; an hourly end covers its whole day.
    """
    hourly = F.col(temporal) == "hourly"
    begin, last_day = (F.col(c).cast("date").cast("timestamp_ntz") for c in (start, end))
    finish = F.when(hourly, last_day + F.expr("interval 23 hours")).otherwise(last_day)
    step = F.when(hourly, F.expr("interval 1 hour")).otherwise(F.expr("interval 24 hours"))
    first, last = F.col("held_min"), F.col("held_max")

    def span(low: Column, high: Column) -> Column:
        return F.struct(low.alias("range_start"), high.alias("range_end"))

    bounds = held.select(*keys, F.col("held_min").cast("timestamp_ntz").alias("held_min"),
                         F.col("held_max").cast("timestamp_ntz").alias("held_max"))
    edges = F.array_compact(F.array(F.when(begin < first, span(begin, first - step)),
                                    F.when(finish > last, span(last + step, finish))))
    return (requests.join(bounds, keys, "left")
            .withColumn("ranges", F.when(first.isNull(), F.array(span(begin, finish))).otherwise(edges)))


def fetch_plan(planned: DataFrame) -> DataFrame:
    """One row per range to fetch, with the day keys the service takes."""
    keep = [c for c in planned.columns if c != "ranges"]
    return (planned.select(*keep, F.posexplode("ranges").alias("range_no", "_r"))
            .select(*keep, (F.col("range_no") + 1).alias("range_no"), "_r.range_start", "_r.range_end",
                    date_key(F.col("_r.range_start")).alias("start_key"),
                    date_key(F.col("_r.range_end")).alias("end_key")))


def _step(temporal: str) -> Column:
    return F.when(F.col(temporal) == "hourly", F.expr("interval 1 hour")).otherwise(F.expr("interval 24 hours"))


def _asked_window(temporal: str, start: str, end: str) -> tuple[Column, Column]:
    """First and last stamp of a request: whole days, an hourly end with its whole day."""
    begin, last_day = (F.col(c).cast("date").cast("timestamp_ntz") for c in (start, end))
    return begin, F.when(F.col(temporal) == "hourly", last_day + F.expr("interval 23 hours")).otherwise(last_day)


def held_gaps(obs: DataFrame, keys: list[str], temporal: str = "temporal", stamp: str = "obs_ts") -> DataFrame:
    """Holes inside what is held: `keys..., gap_start, gap_end`, both of them stamps that are missing.

    Neighbouring stamps are compared inside blocks (a year of days, a month of hours), so however
    long the history of one key is, a task orders one block of it. Blocks are then stitched by
    their first and last stamps, of which a key has one pair a block. No calendar is built.
    """
    return _gaps(*_held_blocks(obs, keys, temporal, stamp), keys, temporal, stamp)


def _held_blocks(obs: DataFrame, keys: list[str], temporal: str, stamp: str) -> tuple[DataFrame, DataFrame]:
    """Distinct stamps with their `_block`, and first and last stamp of every block.

    The stamps are dealt by key and block here, whatever dealt them before, so that all that reads them shares one
    shuffle and no task gets whole keys with all their blocks.
    """
    at = F.col(stamp)
    block = F.when(F.col(temporal) == "hourly", F.year(at) * 12 + F.month(at)).otherwise(F.year(at))
    # repeats (variants of a key, copies of a row) go before anything is ordered
    held = (obs.select(*keys, at.cast("timestamp_ntz").alias(stamp)).withColumn("_block", block).distinct()
            .repartition(*keys, "_block"))
    return held, held.groupBy(*keys, "_block").agg(F.min(stamp).alias("_first"), F.max(stamp).alias("_last"))


def _gaps(held: DataFrame, blocks: DataFrame, keys: list[str], temporal: str, stamp: str) -> DataFrame:
    at = F.col(stamp)
    inside = held.withColumn("_before", F.lag(stamp).over(Window.partitionBy(*keys, "_block").orderBy(stamp))).drop("_block")
    seams = blocks.select(*keys, F.col("_first").alias(stamp), F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block")).alias("_before"))
    step = _step(temporal)
    return (inside.unionByName(seams).where(at - F.col("_before") > step)
            .select(*keys, (F.col("_before") + step).alias("gap_start"), (at - step).alias("gap_end")))


def fetch_holes(requests: DataFrame, obs: DataFrame, keys: list[str], temporal: str = "temporal",
                start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per range that a request lacks, holes inside the held span included.

    The fetch plan of the other mode: nothing held is asked for again and nothing outside a request is, so disjoint
    requests are not bridged. `keys` include the resolution. Holes and requests meet on
    the key and a year they share, and each pair is kept in the first such year.
    """
    begin, finish = _asked_window(temporal, start, end)
    asked = requests.withColumns({"_s": begin, "_e": finish}).where("_s <= _e")
    mine = obs.join(requests.select(*keys).distinct(), keys, "left_semi")
    held, blocks = _held_blocks(mine, keys, temporal, "obs_ts")
    kind = obs.schema["obs_ts"].dataType
    bounds = blocks.groupBy(*keys).agg(F.min("_first").cast(kind).alias("_lo"), F.max("_last").cast(kind).alias("_hi"))
    step = _step(temporal)
    low, high, s, e = (F.col(c) for c in ("_lo", "_hi", "_s", "_e"))

    def span(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.struct(first.alias("range_start"), last.alias("range_end")))

    edges = F.when(low.isNull(), F.array(span(s, e))).otherwise(F.array_compact(F.array(
        span(s, F.least(e, low - step)), span(F.greatest(s, high + step), e))))
    outside = asked.join(bounds, keys, "left").select(*requests.columns, F.explode(edges).alias("_r")).select(*requests.columns, "_r.*")

    def years(frame: DataFrame, first: str, last: str) -> DataFrame:
        return frame.withColumn("_year", F.explode(F.sequence(F.year(first), F.year(last))))

    gaps = years(_gaps(held, blocks, keys, temporal, "obs_ts"), "gap_start", "gap_end")
    met = years(asked, "_s", "_e").join(gaps, [*keys, "_year"]).where((F.col("gap_start") <= e) & (F.col("gap_end") >= s))
    inside = met.where(F.col("_year") == F.greatest(F.year(s), F.year("gap_start"))).select(
        *requests.columns, F.greatest(s, F.col("gap_start")).alias("range_start"), F.least(e, F.col("gap_end")).alias("range_end"))
    return outside.unionByName(inside).withColumns({"start_key": date_key(F.col("range_start")), "end_key": date_key(F.col("range_end"))})


def fetch_payloads(plan: DataFrame, keys: list[str]) -> DataFrame:
    """One row per call to the service: `keys, temporal, range_start, range_end, chunk_no, params`.

    Takes the fetch plan of single parameters. Parameters of one site and range travel
    together, sorted, in lists no longer than the service allows.
    """
    limit = F.when(F.col("temporal") == "hourly", F.lit(MAX_PARAMS_HOURLY)).otherwise(F.lit(MAX_PARAMS_DAILY))
    call = [*keys, "temporal", "range_start", "range_end"]
    # Codes of the catalogue bound the set; a code asked for twice is fetched once.
    together = plan.groupBy(*call).agg(F.sort_array(F.collect_set("param")).alias("_all")).withColumn("_n", limit)
    return (together.withColumn("chunk_no", F.explode(F.sequence(F.lit(1), F.ceil(F.size("_all") / F.col("_n")).cast("int"))))
            .select(*call, "chunk_no", F.slice("_all", (F.col("chunk_no") - 1) * F.col("_n") + 1, F.col("_n")).alias("params")))


def plan_hit_rate(planned: DataFrame) -> DataFrame:
    """Requests, fully held ones and their share in percent (0 when there are none)."""
    hit = F.count_if(F.size("ranges") == 0)
    total = F.count("*")
    return planned.agg(
        total.alias("total_requests"), hit.alias("store_hits"),
        F.coalesce(F.sum(F.size("ranges")), F.lit(0)).cast("bigint").alias("ranges_to_fetch"),
        F.when(total > 0, F.round(hit * 100.0 / F.nullif(total, F.lit(0)), 1)).otherwise(F.lit(0.0)).alias("hit_rate_pct"))


def served_from(planned: DataFrame, status: str = "fetch_status") -> DataFrame:
    """Add `served_from`: store, fresh, stale or error.

    A refused request (HTTP 400 or 422) is an error even when rows are held; any
    other failure falls back to the held rows.
    """
    refused = F.col(status).rlike(r"^HTTP (400|422)")
    return planned.withColumn(
        "served_from",
        F.when(F.size("ranges") == 0, F.lit("store")).when(F.col(status) == "ok", F.lit("fresh"))
        .when(refused, F.lit("error")).when(F.col("held_min").isNotNull(), F.lit("stale"))
        .otherwise(F.lit("error")))


def stale_rows(served: DataFrame, history: DataFrame, keys: list[str], temporal: str = "temporal",
               start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Held rows of the windows of stale requests: the request's columns, `obs_ts` and `value`.

    `served` is what `served_from` returns. A window and the history meet on the key and the year, of which
    a window covers few, and the bounds then decide; a key with a long history is spread over its years.
    """
    begin, finish = _asked_window(temporal, start, end)
    asked = served.where("served_from = 'stale'").withColumns({"_s": begin, "_e": finish}).where("_s <= _e")
    windows = asked.withColumn("year", F.explode(F.sequence(F.year("_s"), F.year("_e"))))
    rows = history if "year" in history.columns else history.withColumn("year", F.year("obs_ts"))
    rows = rows.select(*keys, "year", F.col("obs_ts").cast("timestamp_ntz").alias("obs_ts"), "value")
    return (windows.join(rows, [*keys, "year"]).where(F.col("obs_ts").between(F.col("_s"), F.col("_e")))
            .select(*served.columns, "obs_ts", "value"))


def failed_points(requests: DataFrame, results: DataFrame, reasons: DataFrame, keys: list[str]) -> DataFrame:
    """Requests without a result row, each with a `reason`.

    `reasons` has the keys and `reason`; a request nobody explains says so.
    """
    why = reasons.groupBy(*keys).agg(F.min("reason").alias("reason"))
    return (requests.join(results.select(*keys), keys, "left_anti").join(why, keys, "left")
            .withColumn("reason", F.coalesce("reason", F.lit("no data returned"))))


def failure_sample(failures: DataFrame, order: str, shown: int = 5, quoted: int = 3) -> DataFrame:
    """One row: failure count, the first few in order, how many more, and distinct first messages."""
    first = failures.select(F.col(order).alias("ord"), "reason").orderBy("ord").limit(max(shown, quoted))
    total = failures.agg(F.count("*").alias("failed_count"))
    listed = F.array_sort(F.collect_list(F.struct("ord", "reason")))
    head = (first.agg(listed.alias("_l"))
            .select(F.array_join(F.transform(F.slice("_l", 1, shown), lambda x: F.concat(
                        x["ord"].cast("string"), F.lit(": "), x["reason"])), "; ").alias("shown"),
                    F.array_join(F.array_distinct(F.transform(F.slice("_l", 1, quoted), lambda x: x["reason"])),
                                 ", ").alias("messages")))
    # Two single-row tables folded into one row.
    return (total.unionByName(head, allowMissingColumns=True)
            .agg(F.max("failed_count").alias("failed_count"), F.max("shown").alias("shown"),
                 F.max("messages").alias("messages"))
            .select("failed_count", "shown",
                    F.greatest(F.col("failed_count") - shown, F.lit(0)).alias("more_count"), "messages"))
