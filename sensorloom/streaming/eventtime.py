"""Streams with event time: bounded state, windows that are emitted once, a cursor that can be read.

The versioned tables of ``refresh`` lose no row, however late it comes, and their reads combine
what batches wrote. Here a watermark says how long a stream waits for late rows: state older than it
is forgotten, rows older than it are dropped and counted, and results are final when they come.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructType

from sensorloom.operators.features import complete_features
from sensorloom.schemas import CALENDAR_COLUMNS, LAG_COLUMNS, LAGS, SERIES_KEY
from sensorloom.functions import calendar_columns
from sensorloom.session import filesystem

#: How long a stream waits for late readings, unless told otherwise.
ALLOWANCE = "24 hours"
#: A sensor that was silent for so long is forgotten; its next reading begins a new series.
SILENCE_DAYS = 60
#: Lags in state are made for groups of sensors, by a hash of the id; a group's state has so many entries.
SENSOR_GROUPS, GROUP_ENTRIES = 512, 128
#: Rows of one Arrow batch that lags come out in.
ROWS_OUT = 50_000
CURSOR = (
    "query string, batch_id long, n_rows long, earliest timestamp, latest timestamp, "
    "watermark timestamp, n_late long, n_state long"
)
_NO_TIME, _NOTHING = np.iinfo(np.int64).min, (np.empty(0, "i8"), np.empty(0, "f8"))
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def unique_readings(readings: DataFrame, allowance: str = ALLOWANCE) -> DataFrame:
    """The first to come of readings of one sensor and time, within the watermark.

    State holds the keys of the allowance, not of all time. For copies with other values, and for
    copies that come later than that, use the versioned form (``aggregates.distinct_readings``).
    """
    return readings.withWatermark("datetime", allowance).dropDuplicatesWithinWatermark(SERIES_KEY)


def final_windows(
    readings: DataFrame, interval: str = "1 hour", allowance: str = ALLOWANCE
) -> DataFrame:
    """Mean and count per sensor and window, in append mode: each window once, when it is over.

    A window is over when the watermark has passed its end; readings of it that come in a later batch
    are dropped. Windows that never get so far are not emitted.
    """
    return (
        readings.withWatermark("datetime", allowance)
        .groupBy("sensor_id", F.window("datetime", interval).alias("span"))
        .agg(F.avg("pm25").alias("pm25"), F.count("pm25").alias("n"))
        .select("sensor_id", F.col("span.start").alias("datetime"), "pm25", "n")
    )


class LastReadings(StatefulProcessor):
    """The last readings of each sensor as map state; rows that move forward get their lags.

    A key is a group of sensors, whose rows of a batch are sorted and shifted together as arrays: a
    call and its Arrow batches cost far more than the rows of one sensor. Few sensors share an entry
    of the map, and a batch reads and writes the entries of its own sensors only.

    A reading at or before the sensor's last one changes rows that are out already, so it comes
    out with ``late`` set and no lags: the versioned tables take it. Silent sensors are forgotten by
    the group's timer, which is never later than the first of its sensors is due.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        tails = StructType().add("sensors", ArrayType(StringType())).add("sizes", ArrayType(IntegerType()))
        tails = tails.add("readings", BinaryType())
        self.tails = handle.getMapState("tails", StructType().add("entry", IntegerType()), tails)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        come, owner, times, values = _newest_of_each_time(rows)
        held = {e: _unpacked(self.tails.getValue((e,))) for e in {_entry(s) for s in come}}
        for sensor in come:
            held[_entry(sensor)].setdefault(sensor, _NOTHING)
        sensors = np.array([s for tails in held.values() for s in tails], object)
        tails = [t for tails in held.values() for t in tails.values()]
        places = {s: i for i, s in enumerate(sensors)}
        owner = np.array([places[s] for s in come])[owner]
        last = np.array([t[-1] if len(t) else _NO_TIME for t, _ in tails])
        behind = times <= last[owner]
        for part in _parts(np.flatnonzero(behind)):
            made = {"sensor_id": sensors[owner[part]], "datetime": times[part].view("M8[us]"), "pm25": values[part]}
            yield pd.DataFrame(made | {"late": True} | dict.fromkeys(LAG_COLUMNS, np.nan))
        if behind.all():
            return
        # Each sensor's tail, then its new readings.
        lengths = np.array([len(t) for t, _ in tails])
        owner = np.concatenate([np.repeat(np.arange(len(sensors)), lengths), owner[~behind]])
        times = np.concatenate([*[t for t, _ in tails], times[~behind]])
        values = np.concatenate([*[v for _, v in tails], values[~behind]])
        order = np.argsort(owner, kind="stable")
        owner, times, values = owner[order], times[order], values[order]
        ends = np.searchsorted(owner, np.arange(len(sensors)), side="right")
        starts = np.concatenate([[0], ends[:-1]])
        self._keep(held, sensors, times, values, ends, starts, grown=ends - starts > lengths)
        place = np.arange(len(owner)) - starts[owner]
        for part in _parts(np.flatnonzero(order >= lengths.sum())):
            made = {"sensor_id": sensors[owner[part]], "datetime": times[part].view("M8[us]"), "pm25": values[part], "late": False}
            for i, name in enumerate(LAG_COLUMNS, 1):
                made[name] = np.where(place[part] >= i, values[np.maximum(part - i, 0)], np.nan)
            yield pd.DataFrame(made)

    def _keep(self, held, sensors, times, values, ends, starts, grown) -> None:
        """Write the entries of which some sensor has grown."""
        sizes = np.minimum(ends - starts, LAGS)
        kept = np.repeat(ends, ends - starts) - np.arange(len(times)) <= LAGS
        times, values, cuts = times[kept], values[kept], np.concatenate([[0], np.cumsum(sizes)])
        upto = 0
        for entry, tails in held.items():
            some = slice(upto, upto := upto + len(tails))
            if grown[some].any():
                part = slice(cuts[some.start], cuts[some.stop])
                self.tails.updateValue((entry,), _packed(sensors[some], sizes[some], times[part], values[part]))
        newest = times[cuts[1:] - 1]
        self._wake_by(_forgotten_at(newest[grown].min()))

    def _wake_by(self, at: int) -> None:
        """A group has one timer, which may go off early but not late."""
        timers = list(self.handle.listTimers())
        if not timers or at < min(timers):
            for old in timers:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due, changed = timerValues.getCurrentWatermarkInMs(), [], {}
        for (entry,), state in self.tails.iterator():
            held = _unpacked(state)
            left = {s: tail for s, tail in held.items() if _forgotten_at(tail[0][-1]) > now}
            due += [_forgotten_at(t[-1]) for t, _ in left.values()]
            if len(left) < len(held):
                changed[entry] = left
        for entry, left in changed.items():
            if left:
                times, values = (np.concatenate([tail[i] for tail in left.values()]) for i in (0, 1))
                sizes = np.array([len(t) for t, _ in left.values()])
                self.tails.updateValue((entry,), _packed(left, sizes, times, values))
            else:
                self.tails.removeKey((entry,))
        if due:
            self.handle.registerTimer(min(due))
        yield from ()

    def close(self) -> None:
        pass


def _entry(sensor: str | None) -> int:
    """Which entry of its group's state holds a sensor."""
    return zlib.crc32((sensor or "").encode()) % GROUP_ENTRIES


def _packed(sensors: Iterable[str | None], sizes: np.ndarray, times: np.ndarray, values: np.ndarray) -> tuple:
    return list(sensors), sizes.tolist(), times.tobytes() + values.tobytes()


def _unpacked(state: tuple | None) -> dict[str | None, tuple[np.ndarray, np.ndarray]]:
    """Times and values of each sensor of an entry."""
    if state is None:
        return {}
    sensors, sizes, raw = state
    half = len(raw) // 2
    times, values = np.frombuffer(raw, "i8", count=half // 8), np.frombuffer(raw, "f8", offset=half)
    ends = np.cumsum(sizes).tolist()
    return {s: (times[e - n : e], values[e - n : e]) for s, n, e in zip(sensors, sizes, ends, strict=True)}


def _newest_of_each_time(rows: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sensors, and as arrays in the order of sensor and time: which sensor, microseconds, values.

    Of the readings of one sensor and time, the largest value stays; NaN is above all numbers.
    """
    columns = [(c["sensor_id"], c["datetime"].to_numpy("M8[us]"), c["pm25"].to_numpy("f8")) for c in rows]
    owner, sensors = pd.factorize(pd.concat([c[0] for c in columns]).to_numpy(object), use_na_sentinel=False)
    sensors = np.array([s if isinstance(s, str) else None for s in sensors], object)
    times, values = (np.concatenate([c[i] for c in columns]) for i in (1, 2))
    if np.isnat(times).any():
        raise ValueError("a reading without a time has no place in a series")
    times = times.view("i8")
    order = np.lexsort((values, times, owner))
    owner, times, values = owner[order], times[order], values[order]
    stays = np.append((owner[1:] != owner[:-1]) | (times[1:] != times[:-1]), True)
    return sensors, owner[stays], times[stays], values[stays]


def _parts(places: np.ndarray) -> Iterator[np.ndarray]:
    """Some at a time, so that a group with very many rows doesn't get all its lags at once."""
    return (places[i : i + ROWS_OUT] for i in range(0, len(places), ROWS_OUT))


def _forgotten_at(last: int) -> int:
    """Milliseconds at which a sensor is forgotten."""
    return int(last) // 1000 + SILENCE_DAYS * 86_400_000


def lags_in_state(readings: DataFrame, allowance: str = ALLOWANCE, groups: int = SENSOR_GROUPS) -> DataFrame:
    """Readings with their lags from per-sensor state, as a stream: low latency, no table is read.

    Needs the RocksDB state store (``ROCKSDB``) and batches that bring a sensor's readings in time
    order. ``late`` marks the others. One task holds a batch's readings of a group of sensors;
    ``groups`` has to stay the same as long as a checkpoint is used.
    """
    fields = ", ".join(f"{c} double" for c in LAG_COLUMNS)
    group = F.pmod(F.xxhash64("sensor_id"), F.lit(groups)).cast("int").alias("sensors")
    return (
        readings.select("sensor_id", "datetime", "pm25")
        .withWatermark("datetime", allowance)
        .select(group, "sensor_id", "datetime", "pm25")
        .groupBy("sensors")
        .transformWithStateInPandas(
            LastReadings(),
            outputStructType=f"sensor_id string, datetime timestamp, pm25 double, late boolean, {fields}",
            outputMode="Append",
            timeMode="EventTime",
        )
    )


def state_features(lagged: DataFrame) -> DataFrame:
    """Feature rows of ``lags_in_state``: forward rows with all their lags, with calendar columns."""
    rows = lagged.filter(~F.col("late")).select(
        "sensor_id", "datetime", "pm25", *calendar_columns(F.col("datetime")), *LAG_COLUMNS
    )
    return complete_features(rows.select("sensor_id", "datetime", "pm25", *CALENDAR_COLUMNS, *LAG_COLUMNS))


class CursorLog(StreamingQueryListener):
    """Writes one line per batch of every query to a folder: how far event time has come, what was late.

    A line is a small file of its own, written by the driver while the stream goes on; no job runs.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.write(json.loads(event.progress.json))

    def write(self, progress: dict) -> None:
        times, states = progress.get("eventTime") or {}, progress.get("stateOperators") or []
        row = {
            "query": progress.get("name") or progress["id"],
            "batch_id": progress["batchId"],
            "n_rows": progress["numInputRows"],
            "earliest": times.get("min"),
            "latest": times.get("max"),
            "watermark": times.get("watermark"),
            "n_late": sum(s["numRowsDroppedByWatermark"] for s in states),
            "n_state": sum(s["numRowsTotal"] for s in states),
        }
        name = f"{self.path}/{progress['runId']}-{progress['batchId']:012d}-{row['n_rows']}.json"
        fs, target = filesystem(self.spark, name)
        out = fs.create(target, True)
        out.write(bytearray(json.dumps(row).encode() + b"\n"))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a ``CursorLog``: rows, event times, watermark and late rows of every batch."""
    return spark.read.schema(CURSOR).json(path)
