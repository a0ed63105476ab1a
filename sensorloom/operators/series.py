"""Windows that look a fixed number of rows back, safe for very long series.

A window partitioned by sensor puts a whole series into one task. Series above a row limit
are therefore cut into time slices; each slice is handed the few rows before its start, so a
slice can be computed alone and the result is the same as over the uncut series.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sensorloom.session import stored

ROWS_PER_TASK = 10_000_000

_SLICE, _CARRIED = "_slice", "_carried"


def _computed(df: DataFrame) -> bool:
    """Does the plan hold more than scans of files, filters and projections?"""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return bool(re.search(r"^[\s:+|-]*(Aggregate|Join|Window|Sort|Generate|Distinct|Repartition)", plan, re.MULTILINE))


def _oversized(sliced: DataFrame, key: str, time: str, rows: int, first: bool) -> DataFrame:
    """Series or slices with more than ``rows`` rows, and how wide to cut them.

    Rows of one series and one time can't be cut; de-duplicate first where these may be many.
    """
    micros = F.unix_micros(time)
    parts = F.ceil(F.col("n") * 2 / rows)
    scope = sliced if first else sliced.filter(F.col(_SLICE).isNotNull())
    return (
        scope.groupBy(key, _SLICE)
        .agg(F.count(F.lit(1)).alias("n"), F.min(micros).alias("lo"), F.max(micros).alias("hi"))
        .filter((F.col("n") > rows) & (F.col("hi") > F.col("lo")))
        .select(
            F.col(key).alias("c_key"),
            F.col(_SLICE).alias("c_slice"),
            F.col("lo").alias("c_lo"),
            F.ceil((F.col("hi") - F.col("lo") + 1) / parts).alias("c_width"),
        )
    )


def _cut(df: DataFrame, key: str, time: str, rows: int) -> tuple[DataFrame, bool]:
    """Add the start (microseconds) of each row's slice; null where the series is not cut.

    The cuts are a written table, however many they are. Its size is known to Spark, which
    broadcasts it only below its limit.
    """
    sliced, first = df.withColumn(_SLICE, F.lit(None).cast("long")), True
    while True:
        cuts = stored(_oversized(sliced, key, time, rows, first), "cuts")
        if cuts.isEmpty():
            return sliced, not first
        steps = F.floor((F.unix_micros(time) - F.col("c_lo")) / F.col("c_width"))
        sliced = (
            sliced.join(
                cuts,
                F.col(key).eqNullSafe(F.col("c_key")) & F.col(_SLICE).eqNullSafe(F.col("c_slice")),
                "left",
            )
            .withColumn(_SLICE, F.coalesce(F.col("c_lo") + steps * F.col("c_width"), _SLICE))
            .select(*df.columns, _SLICE)
        )
        first = False


def _carried_rows(sliced: DataFrame, depth: int, values: Sequence[str], key: str, time: str):
    """For each slice, the last ``depth`` rows before it.

    Every slice keeps its own last ``depth`` rows (Spark applies that limit before the
    shuffle too). ``depth`` earlier slices always suffice, since each holds a row.
    """
    newest_first = Window.partitionBy(key, _SLICE).orderBy(F.col(time).desc())
    before = Window.partitionBy(key).orderBy(_SLICE).rowsBetween(-depth, -1)
    earlier = F.flatten(F.collect_list("tail").over(before))
    return (
        sliced.filter(F.col(_SLICE).isNotNull())
        .select(key, _SLICE, time, *values)
        .withColumn("rank", F.row_number().over(newest_first))
        .filter(F.col("rank") <= depth)
        .groupBy(key, _SLICE)
        .agg(F.sort_array(F.collect_list(F.struct(time, *values))).alias("tail"))
        .select(key, _SLICE, earlier.alias("earlier"))
        .select(
            key,
            _SLICE,
            F.inline(
                F.slice("earlier", F.greatest(F.size("earlier") - depth + 1, F.lit(1)), depth)
            ),
        )
    )


def over_history(
    df: DataFrame,
    depth: int,
    columns: Callable[[WindowSpec], list[Column]],
    values: Sequence[str] = (),
    key: str = "sensor_id",
    time: str = "datetime",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Append ``columns(window)``, which may look at most ``depth`` rows back in their series.

    ``values`` names the columns, besides ``time``, that they read. One grouped count decides
    whether any series must be cut; if none must, the plan is one shuffle, sort and window. An
    input that takes more than a scan is written first, so that it is computed once. Rows without
    a time have no place in a series and are left out.
    """
    df = df.filter(F.col(time).isNotNull())
    if _computed(df):
        df = stored(df, "series")
    sliced, cut = _cut(df, key, time, rows_per_task)
    if not cut:
        return df.select("*", *columns(Window.partitionBy(key).orderBy(time)))
    carried = _carried_rows(sliced, depth, values, key, time)
    rows = sliced.withColumn(_CARRIED, F.lit(False)).unionByName(
        carried.withColumn(_CARRIED, F.lit(True)), allowMissingColumns=True
    )
    window = Window.partitionBy(key, _SLICE).orderBy(time)
    return rows.select("*", *columns(window)).filter(~F.col(_CARRIED)).drop(_SLICE, _CARRIED)
