"""Counter to power as keyed state: readings wait for the watermark, the last one per meter is kept.

What is held is one reading per meter and the readings of the lateness, packed by hour, so state grows with
rate x lateness and never with the length of the stream. A meter is one key; where one meter alone is more than a
task can take, ``jobs.counter_power_stream`` spreads it by time chunks instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timecols import HOUR
from ..session import ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_US = HOUR * 1_000_000


def power_of(ts_us: np.ndarray, energy: np.ndarray, last: tuple[int, float] | None) -> np.ndarray:
    """kW of readings in time order after ``last``; NaN where :func:`counter_to_power` gives NULL."""
    first = last or (0, np.nan)
    gained = np.diff(energy, prepend=first[1])
    hours = np.diff(ts_us, prepend=first[0]) / 3.6e9
    return np.where((gained >= 0) & (hours > 0), gained / np.where(hours > 0, hours, 1.0), np.nan)


def _columns(packed: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Stamps and energies of packed hours, in time order, the lowest energy first among equal stamps."""
    both = np.concatenate([np.frombuffer(p, dtype=[("ts", "<i8"), ("energy", "<f8")]) for p in packed])
    order = np.lexsort((both["energy"], both["ts"]))
    return both["ts"][order], both["energy"][order]


def _packed(ts_us: np.ndarray, energy: np.ndarray) -> bytes:
    out = np.empty(len(ts_us), dtype=[("ts", "<i8"), ("energy", "<f8")])
    out["ts"], out["energy"] = ts_us, energy
    return out.tobytes()


class PowerState(StatefulProcessor):
    """Readings of open hours wait; a timer at the end of an hour gives out its readings in order."""

    def __init__(self, keys: Sequence[str], ts: str, energy: str, power: str):
        self.keys, self.ts, self.energy, self.power = list(keys), ts, energy, power

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts long, energy double")
        self.waiting = handle.getMapState("waiting", "hour long", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            ts_us = pdf[self.ts].to_numpy().astype("datetime64[us]").astype("int64")
            energy = pdf[self.energy].to_numpy(dtype="float64", na_value=np.nan)
            hours = ts_us // HOUR_US
            for hour in np.unique(hours):
                own, at = hours == hour, (int(hour),)
                held = self.waiting.getValue(at)[0] if self.waiting.containsKey(at) else b""
                if not held:
                    self.handle.registerTimer((int(hour) + 1) * HOUR * 1000)
                self.waiting.updateValue(at, (bytes(held) + _packed(ts_us[own], energy[own]),))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = (expiredTimerInfo.getExpiryTimeInMs() // (HOUR * 1000) - 1,)
        if not self.waiting.containsKey(at):
            return
        ts_us, energy = _columns([bytes(self.waiting.getValue(at)[0])])
        self.waiting.removeKey(at)
        first = np.diff(ts_us, prepend=ts_us[0] - 1) > 0
        ts_us, energy = ts_us[first], energy[first]
        last = self.last.get() if self.last.exists() else None
        if last is not None:
            last = (last[0], np.nan if last[1] is None else last[1])
        power = power_of(ts_us, energy, last)
        end = float(energy[-1])
        self.last.update((int(ts_us[-1]), None if np.isnan(end) else end))
        yield pd.DataFrame(
            {k: [v] * len(ts_us) for k, v in zip(self.keys, key)}
            | {self.ts: ts_us.astype("datetime64[us]"), self.energy: energy, self.power: power}
        )


def counter_power_state(
    stream: DataFrame, keys: Sequence[str], ts: str = "ts", energy: str = "value", power: str = "power", lateness: str = "2 days"
) -> DataFrame:
    """Streaming (keys, ts, energy, power): an hour's readings come out once the watermark has passed its end.

    Files may hold readings in any order within the lateness; later ones are dropped, as behind any watermark, and so
    are readings without a stamp. Of readings of one stamp the lowest counts, an unknown one only if it is alone. The
    session keeps its state in RocksDB from here on.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_package(spark)
    rows = stream.where(F.col(ts).isNotNull()).select(*keys, ts, F.col(energy).cast("double").alias(energy)).withWatermark(ts, lateness)
    schema = T.StructType([*[rows.schema[c] for c in (*keys, ts, energy)], T.StructField(power, T.DoubleType())])
    return rows.groupBy(*keys).transformWithStateInPandas(PowerState(keys, ts, energy, power), schema, "append", "eventTime")
