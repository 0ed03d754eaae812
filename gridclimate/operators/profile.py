"""Summaries of observations and of the request log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclimate.functions.dates import clock_micros
from gridclimate.functions.text import format_bytes, round_half_even
from gridclimate.sources.catalog import RATE_LIMIT_CALLS, RATE_LIMIT_SECONDS


def profile_wide(wide: DataFrame, params: list[str], stamp: str = "obs_ts") -> DataFrame:
    """Start, end, rows, missing cells, all cells and the parameter list of a wide table."""
    missing = sum((F.count_if(F.col(p).isNull()) for p in params), F.lit(0).cast("bigint"))
    return wide.agg(
        F.min(stamp).alias("start_ts"), F.max(stamp).alias("end_ts"), F.count("*").alias("data_points"),
        missing.alias("missing_values"), (F.count("*") * len(params)).alias("total_cells"),
        F.lit(", ".join(params)).alias("parameters"))


def profile_by_param(obs: DataFrame, stamp: str = "obs_ts") -> DataFrame:
    """The same figures per parameter of a long table."""
    return obs.groupBy("param").agg(
        F.min(stamp).alias("start_ts"), F.max(stamp).alias("end_ts"), F.count("*").alias("data_points"),
        F.count_if(F.col("value").isNull()).alias("missing_values"))


def store_stats(entries: DataFrame, stamp: str, payload: str) -> DataFrame:
    """Entry count, oldest, newest and total payload bytes."""
    size = F.coalesce(F.sum(F.octet_length(payload).cast("bigint")), F.lit(0))
    return (entries.agg(F.count("*").alias("entries"), F.min(stamp).alias("oldest"),
                        F.max(stamp).alias("newest"), size.alias("total_bytes"))
            .withColumn("total_size", format_bytes(F.col("total_bytes"))))


def growing_degree_days(temperature: Column, base: float = 10.0) -> Column:
    """Degrees above the base, never negative; unknown temperature stays unknown."""
    return F.when(temperature.isNotNull(), F.greatest(temperature - base, F.lit(0.0)))


#: Bits of the fraction that a coarse and a fine slice keep.
COARSE_BITS, FINE_BITS = 10, 31


def value_slice(value: Column, bits: int) -> Column:
    """Number of the slice that holds a double: its exponent and the first bits of its fraction, in the order of the values.

    A function of the value alone: scaling by a power of two is exact, and the logarithm's rounding is
    put right by comparing with that power. NaN is above everything, as Spark sorts it.
    """
    size = F.abs(value)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022).cast("bigint"))
    power = F.pow(F.lit(2.0), guess.cast("double"))
    exponent = guess + F.when(size < power, F.lit(-1)).when(size / power >= 2, F.lit(1)).otherwise(F.lit(0))
    exponent = F.greatest(exponent, F.lit(-1022).cast("bigint"))  # smaller numbers share the last exponent
    fraction = size / F.pow(F.lit(2.0), exponent.cast("double"))
    place = (exponent + 1024) * F.lit(1 << bits) + F.floor(fraction * float(1 << bits))
    top = F.lit(4096 << bits)
    endless = F.when(F.isnan(value) | (value == float("inf")), top).when(value == float("-inf"), -top)
    return F.coalesce(endless, F.when(value == 0, F.lit(0).cast("bigint")).when(value < 0, -place).otherwise(place))


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float],
                    also: list[Column] | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation) per group, without gathering or sorting a group.

    Repeated values are counted before the only large shuffle. Rows are then counted per
    slice of the number line, the slices that hold a wanted rank are cut again, and only the
    values of those fine slices are ordered. Slices are numbered by the value alone, so no group
    needs cut points of its own; how many a group can have, and how many different doubles a fine slice can hold
    (2^21), is set by the format of a double, whatever the size of the data. `also` holds further aggregates over the group.
    """
    counted = (df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
               .withColumn("_coarse", value_slice(F.col("_v"), COARSE_BITS)))
    ranks = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    wanted_ranks = [r for place in ranks.values() for r in (F.floor(place), F.ceil(place))]

    def hit(skip: Column, rows: Column) -> Column:
        return reduce(lambda a, b: a | b, [(r >= skip) & (r < skip + rows) for r in wanted_ranks])

    def running(within: list[str], order: str) -> Column:
        before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(before), F.lit(0))

    def chosen(sliced: DataFrame, within: list[str], new: str, carried: list[str]) -> DataFrame:
        """The slices with a wanted rank, the rows before them (`_skip`) and the rows of the group (`_n`)."""
        sizes = sliced.groupBy(*within, new, *carried).agg(F.sum("_c").alias("_rows"))
        if "_n" not in carried:
            sizes = sizes.withColumn("_n", F.sum("_rows").over(Window.partitionBy(*within)))
        skip = running(within, new) + (F.col("_skip") if "_skip" in carried else F.lit(0))
        return sizes.withColumn("_skip", skip).where(hit(F.col("_skip"), F.col("_rows"))).drop("_rows")

    coarse = chosen(counted, groups, "_coarse", [])
    inner = counted.join(coarse, [*groups, "_coarse"]).withColumn("_fine", value_slice(F.col("_v"), FINE_BITS))
    fine = chosen(inner, [*groups, "_coarse"], "_fine", ["_skip", "_n"])
    last = inner.drop("_skip", "_n").join(fine, [*groups, "_coarse", "_fine"]).withColumnRenamed("_c", "_rows")
    placed = last.withColumn("_at", F.col("_skip") + running([*groups, "_coarse", "_fine"], "_v"))

    def pick(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_at")) & (rank < F.col("_at") + F.col("_rows")), F.col("_v")))

    picks = [pick(side(place)).alias(f"{name}_{end}") for name, place in ranks.items() for end, side in (("lo", F.floor), ("hi", F.ceil))]
    found = placed.groupBy(*groups, "_n").agg(*picks).select(*groups, *[
        (F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (place - F.floor(place))).alias(name) for name, place in ranks.items()])
    return df.groupBy(*groups).agg(*also).join(found, groups, "left") if also else found


def describe_params(obs: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per parameter."""
    return exact_quantiles(
        obs, ["param"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75},
        [F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
         F.min("value").alias("min"), F.max("value").alias("max")],
    ).select("param", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


#: Digits behind the point that sums keep exactly, and digits in all.
SUM_SCALE, SUM_DIGITS = 15, 28


def exact_sum(value: Column) -> Column:
    """Sum of doubles that no order of rows and no partial sums change, as far as a wide decimal holds them; else their plain sum."""
    wide = value.try_cast(f"decimal({SUM_DIGITS},{SUM_SCALE})")
    total = F.try_sum(wide).try_cast("double")
    return F.when(F.count(value) == F.count(wide), F.coalesce(total, F.sum(value))).otherwise(F.sum(value))


def window_totals(obs: DataFrame, keys: list[str], mean: str, total: str, digits: int = 2) -> DataFrame:
    """`mean` of one parameter and `total` of another per key, rounded half-even once."""
    averaged, added = (F.when(F.col("param") == p, F.col("value")) for p in (mean, total))
    return obs.groupBy(*keys).agg(
        (exact_sum(averaged) / F.nullif(F.count(averaged), F.lit(0))).alias("mean"),
        F.coalesce(exact_sum(added), F.lit(0.0)).alias("total"),
    ).select(*keys, *[round_half_even(F.col(c), digits).alias(c) for c in ("mean", "total")])


#: Parts that a window is cut into by the rate audit; a whole number of microseconds for every window of whole seconds.
AUDIT_PARTS = 64
#: Parts whose totals one task runs over.
AUDIT_STRETCH = 4096


def rate_audit(log: DataFrame, client: str, stamp: str, calls: int = RATE_LIMIT_CALLS,
               seconds: int = RATE_LIMIT_SECONDS) -> DataFrame:
    """Per call, the calls of its client in the trailing window, and whether that is over the limit.

    A call exactly one window old no longer counts. Simultaneous calls count together.
    The time line is cut into parts of a window. A window holds the calls of its last part so far, the totals of
    the parts before, and of the part with its edge what lies behind the edge. Only single
    parts are ordered call by call, and totals are summed over stretches of parts, so the calls of one
    client within one window spread over many tasks.
    """
    span = seconds * 1_000_000
    us, size = F.col("_us"), span // AUDIT_PARTS
    part = F.floor(us / F.lit(size)).cast("bigint")
    at = log.withColumn("_us", clock_micros(F.col(stamp), log.schema[stamp].dataType))
    tallied = at.where("_us is not null").groupBy(client, "_us").agg(F.count("*").alias("_c"))

    # A call asks for two places: its own, and the window's edge as many parts before as a window has.
    places = tallied.select(client, us.alias("_call"), F.explode(F.array(
        F.struct(us.alias("at"), F.col("_c").alias("c"), F.lit(1).alias("sign")),
        F.struct((us - span).alias("at"), F.lit(0).cast("bigint").alias("c"), F.lit(-1).alias("sign")))).alias("_p")).select(client, "_call", "_p.*")
    so_far = F.sum("c").over(Window.partitionBy(client, F.floor(F.col("at") / F.lit(size))).orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
    ends = (places.withColumn("_so_far", F.col("sign") * so_far).groupBy(client, F.col("_call").alias("_us"))
            .agg(F.sum("_so_far").alias("_ends")).withColumn("_part", part))

    # A stretch also sees the last parts of the stretch before it.
    totals = tallied.groupBy(client, part.alias("_part")).agg(F.sum("_c").alias("_t"))
    stretch = F.floor(F.col("_part") / F.lit(AUDIT_STRETCH)).cast("bigint")
    seen = totals.select(client, "_part", "_t", stretch.alias("_own"), F.explode(F.array_distinct(F.array(
        stretch, F.floor((F.col("_part") + AUDIT_PARTS) / F.lit(AUDIT_STRETCH)).cast("bigint")))).alias("_s"))
    before = Window.partitionBy(client, "_s").orderBy("_part").rangeBetween(-AUDIT_PARTS, -1)
    whole = seen.withColumn("_whole", F.coalesce(F.sum("_t").over(before), F.lit(0))).where("_s = _own").select(
        F.col(client).alias("_client"), F.col("_part").alias("_at_part"), "_whole")

    # null-safe on the client throughout; a call without a stamp stays, with nothing counted
    counted = ends.join(whole, ends[client].eqNullSafe(F.col("_client")) & (F.col("_part") == F.col("_at_part"))).select(
        F.col(client).alias("_of"), F.col("_us").alias("_at"), (F.col("_ends") + F.col("_whole")).alias("calls_in_window"))
    return (at.join(counted, at[client].eqNullSafe(F.col("_of")) & (us == F.col("_at")), "left").drop("_us", "_of", "_at")
            .withColumn("over_limit", F.col("calls_in_window") > calls))
