"""Exact order statistics without sorting or collecting the data.

Each pass counts the remaining rows in bins and keeps the bin that holds the
wanted rank, so a pass is one pre-aggregated scan with a bounded result. A few passes reach a
bin with a single value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
#: Groups whose spans are broadcast and whose bins are fetched: so many rows, times the bins.
MOST_GROUPS = 1000


def group_sizes(df: DataFrame, value: str, by: Column | None = None) -> dict:
    """Rows, smallest and largest value per group. ``by`` must have few distinct values.

    Null and NaN have no rank and don't count.
    """
    group = F.lit(0) if by is None else by
    rows = (
        df.filter(_ranked(df, value))
        .groupBy(group.alias("g"))
        .agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
        .collect()
    )
    return {row.g: (row.n, row.lo, row.hi) for row in rows}


def values_at_rank(
    df: DataFrame,
    value: str,
    ranks: dict,
    by: Column | None = None,
    sizes: dict | None = None,
    bins: int = BINS,
    time: str | None = None,
) -> dict:
    """The value at 0-based position ``ranks[group]`` of each group's sorted values.

    ``value`` is numeric. Give ``sizes`` if ``group_sizes`` was already computed, and ``time`` if
    ``value`` is the microseconds of that column: bounds are then set on it, where scans see them.
    """
    sizes = sizes or group_sizes(df, value, by)
    group = F.lit(0) if by is None else by
    g_type, v_type = (t for _, t in df.select(group.alias("g"), F.col(value).alias("v")).dtypes)
    left = {g: (*sizes[g][1:], rank) for g, rank in ranks.items() if 0 <= rank < sizes[g][0]}
    found = {}
    while True:
        found.update({g: lo for g, (lo, hi, _) in left.items() if lo == hi})
        left = {g: span for g, span in left.items() if span[0] != span[1]}
        if not left:
            return found
        if len(left) > MOST_GROUPS:
            raise ValueError(f"{len(left)} groups; ranks are meant for {MOST_GROUPS} at most")
        # One row per group still open, joined in so that each pass runs the same code. The bounds
        # of all groups together are literals, so that the scan can skip what lies outside.
        spans = df.sparkSession.createDataFrame(
            [(g, lo, hi) for g, (lo, hi, _) in left.items()],
            f"span_g {g_type}, lo {v_type}, hi {v_type}",
        )
        least, most = min(lo for lo, *_ in left.values()), max(hi for _, hi, _ in left.values())
        binned = (
            df.filter(_ranked(df, value) & _between(value, least, most, time))
            .select(group.alias("g"), F.col(value).alias("v"))
            .join(
                F.broadcast(spans),
                F.col("g").eqNullSafe(F.col("span_g")) & F.col("v").between(F.col("lo"), F.col("hi")),
            )
            .groupBy("g", _bin(bins).alias("bin"))
            .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        narrowed = {}
        for g, (_, _, rank) in left.items():
            for row in sorted((r for r in binned if r.g == g), key=lambda r: r.bin):
                if rank < row.n:
                    if (row.lo, row.hi) == left[g][:2]:
                        raise ArithmeticError(f"bins of {value} don't narrow {row.lo} to {row.hi}")
                    narrowed[g] = (row.lo, row.hi, rank)
                    break
                rank -= row.n
        left = narrowed


def _between(value: str, least, most, time: str | None) -> Column:
    if time is None:
        return F.col(value).between(F.lit(least), F.lit(most))
    return F.col(time).between(F.timestamp_micros(F.lit(least)), F.timestamp_micros(F.lit(most)))


def _ranked(df: DataFrame, value: str) -> Column:
    """Has a place among the sorted values. NaN equals itself in Spark, but not in Python."""
    known = F.col(value).isNotNull()
    floating = dict(df.dtypes).get(value) in ("double", "float")
    return known & ~F.isnan(value) if floating else known


def _bin(bins: int) -> Column:
    """Bin of ``v`` between ``lo`` and ``hi``.

    Bins are equally wide, or equally wide in the logarithm where values spread wide. Every
    step is monotone in ``v``, also in floating point, so bins keep the order. The ends fall
    into the first and the last bin, so each pass narrows the span.
    """
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    wide = (lo > 0) & (hi / lo > bins)
    share = F.when(wide, (F.log(v) - F.log(lo)) / (F.log(hi) - F.log(lo))).otherwise(
        (v - lo) / (hi - lo)
    )
    within = F.least(F.greatest(F.floor(share * bins), F.lit(0)), F.lit(bins - 1))
    return F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(within)


def median_rank(n: int) -> int:
    """Position of the lower median: the smallest value with at least half the rows up to it."""
    return (n + 1) // 2 - 1
