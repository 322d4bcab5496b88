"""Stored day summaries of durations: KLL sketches and mergeable moments.

Both are small rows per location and day.  Percentiles, means and
deviations of any range of days come from these rows, without reading
the event log again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import minutes_between
from .delivery import QUANTILES, order_times
from .quality import STAGES, stage_durations, stage_times

#: KLL size parameter, and the rank error it has (single-sided, 99 % confidence).
KLL_K = 800
KLL_RANK_ERROR = 2.296 / KLL_K ** 0.9723


def duration_sketches(events: DataFrame, k: int = KLL_K) -> DataFrame:
    """(location, day, orders, sketch): minutes from created to delivered of
    the orders created on a day.  A sketch has a bounded size, and partial
    sketches are merged before the shuffle."""
    t = order_times(events).filter("order_created_time IS NOT NULL AND delivered_time IS NOT NULL")
    minutes = minutes_between("order_created_time", "delivered_time").cast("double")
    return t.select("location", F.to_date("order_created_time").alias("day"), minutes.alias("minutes")).groupBy(
        "location", "day").agg(F.count(F.lit(1)).alias("orders"),
                               F.expr(f"kll_sketch_agg_double(minutes, {k})").alias("sketch"))


def percentiles_of(sketches: DataFrame, *by: Column) -> DataFrame:
    """P50 / P75 / P99 of any grouping of ``duration_sketches`` rows.

    A percentile is a value whose rank is within ``KLL_RANK_ERROR`` of the
    one asked for.
    """
    ranks = F.array(*[F.lit(q) for q in QUANTILES])
    merged = sketches.groupBy(*by).agg(F.sum("orders").alias("orders"),
                                       F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
    p = F.call_function("kll_sketch_get_quantile_double", F.col("sketch"), ranks)
    kept = [c for c in merged.columns if c != "sketch"]
    return merged.select(*kept, p.alias("p")).select(
        *kept, *[F.col("p")[i].alias(n) for i, n in enumerate(["P50", "P75", "P99"])])


STAGE_NAMES = [n for n, _, _ in STAGES]


def stage_moments(events: DataFrame) -> DataFrame:
    """(location, day, <stage>: struct(n, mean, m2)) per location and day of
    an order's first lifecycle event.  Each load of whole orders gives its
    own rows; several loads are appended and merged on reading."""
    kinds = sorted({k for _, a, b in STAGES for k in (a, b)})
    first = stage_times(events).select("order_id", "location", F.to_date(F.least(*kinds)).alias("day"))
    rows = stage_durations(events).join(first, ["order_id", "location"])
    return rows.groupBy("location", "day").agg(*[
        F.struct(F.count(n).alias("n"), F.coalesce(F.avg(n), F.lit(0.0)).alias("mean"),
                 F.coalesce(F.var_pop(n) * F.count(n), F.lit(0.0)).alias("m2")).alias(n) for n in STAGE_NAMES])


def _merged(parts: Column) -> Column:
    """Parallel variance (Chan): counts, means and squared deviations of two
    sets give those of their union; no difference of large sums."""
    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        step = b["mean"] - a["mean"]
        share = F.when(n > 0, b["n"] / F.greatest(n, F.lit(1))).otherwise(0.0)
        return F.struct(n.alias("n"), (a["mean"] + step * share).alias("mean"),
                        (a["m2"] + b["m2"] + step * step * a["n"] * share).alias("m2"))

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, zero, add)


def moments_summary(moments: DataFrame, *by: Column | str) -> DataFrame:
    """Mean, sample deviation and count of each stage, as
    ``quality.stage_summary``, from stored moments.  A group gathers one
    small row per day and load."""
    cols = []
    g = moments.groupBy(*by).agg(*[F.sort_array(F.collect_list(n)).alias(n) for n in STAGE_NAMES])
    for n in STAGE_NAMES:
        m = F.col(f"{n}_all")
        cols += [F.when(m["n"] > 0, m["mean"]).alias(f"{n}_mean"),
                 F.when(m["n"] > 1, F.sqrt(m["m2"] / F.greatest(m["n"] - 1, F.lit(1)))).alias(f"{n}_std"),
                 m["n"].alias(f"{n}_n")]
    keys = [c for c in g.columns if c not in STAGE_NAMES]
    return g.select(*keys, *[_merged(F.col(n)).alias(f"{n}_all") for n in STAGE_NAMES]).select(*keys, *cols)
