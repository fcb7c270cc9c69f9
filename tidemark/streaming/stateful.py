"""Keyed state over streams: the lookup per reading, windows closed by timers, late readings set aside.

A device that sends a third of all readings must not meet in one task, so each operator spreads or combines its input
first: the lookup deals a device's readings to ``SPREAD`` keys and repeats the few changes for each, windows get one
partial row per task, and lateness is told by a key that has nothing to do with the device.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.times import now_millis
from tidemark.operators.health import is_over, is_spike
from tidemark.operators.lookup import KEY
from tidemark.schemas import GOLD

#: Keys that a device's readings are dealt to.
SPREAD = 16


def _as_text(schema: T.StructType, prefix: str) -> list[Column]:
    """Columns as the text Spark reads back to the same value: pandas would make doubles of integers beside NULLs."""
    return [F.col(f.name).cast("string").alias(f"{prefix}{i}") for i, f in enumerate(schema.fields)]


def _from_text(schema: T.StructType, prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]


def _texts(schema: T.StructType, prefix: str) -> list[str]:
    return [f"{prefix}{i} string" for i in range(len(schema.fields))]


# ---- the lookup, reading by reading ----


class _LookUp(StatefulProcessor):
    """State of a key: the device's row as the last micro-batch left it."""

    def __init__(self, kept: list[str], looked_up: list[str]):
        self.kept, self.looked_up = kept, looked_up

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", ", ".join(f"{c} string" for c in self.looked_up))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(rows), ignore_index=True).sort_values(["at", "is_reading"], kind="stable", ignore_index=True)
        is_change = ~own["is_reading"].to_numpy(bool)
        # The place of the last change before each row, 0 for the version in the state.
        last = np.maximum.accumulate(np.where(is_change, np.arange(1, len(own) + 1), 0))
        known = self.version.get() if self.version.exists() else (None,) * len(self.looked_up)
        out = own.loc[~is_change, self.kept].reset_index(drop=True)
        for i, c in enumerate(self.looked_up):
            values = np.concatenate((np.array([known[i]], object), own[c].to_numpy(object)))
            out[c] = [None if pd.isna(v) else v for v in values[last[~is_change]]]
        if last[-1]:
            newest = own.iloc[last[-1] - 1]
            self.version.update(tuple(None if pd.isna(newest[c]) else newest[c] for c in self.looked_up))
        if len(out):
            yield out

    def close(self) -> None:
        pass


def lookup_per_reading(readings: DataFrame, changes: DataFrame, at: str, columns: list[str], spread: int = SPREAD) -> DataFrame:
    """Left lookup of each reading of a stream in a dimension that is a stream of changes itself.

    Both have ``device_id`` and the time ``at`` of their arrival; ``changes`` has ``columns``, the device's row from then
    on. A reading gets the last change that arrived before it or with it, also when both are in one micro-batch: what came in
    an earlier micro-batch arrived earlier. A device without a change so far, a reading without a device, and a change
    without one, match nothing.

    The only state is a device's current row, ``spread`` times. A change is repeated for each of the device's keys, so
    readings of one device are spread over as many tasks.
    """
    changed = T.StructType([f for f in changes.select(*columns).schema.fields])
    none = lambda texts: [F.lit(None).cast("string").alias(t.split()[0]) for t in texts]
    kept, looked_up = _texts(readings.schema, "r"), _texts(changed, "v")
    position = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(1 << 62))).alias("at")
    spread_by = F.pmod(F.xxhash64(*readings.columns), F.lit(spread)).cast("int").alias("spread")
    both = readings.select(
        F.coalesce(KEY, F.lit("")).alias("device"), F.col(KEY).isNull().alias("nameless"), spread_by, position,
        F.lit(True).alias("is_reading"), *_as_text(readings.schema, "r"), *none(looked_up),
    ).unionByName(
        changes.where(f"{KEY} IS NOT NULL").select(
            F.col(KEY).alias("device"), F.lit(False).alias("nameless"),
            F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("spread"), position, F.lit(False).alias("is_reading"),
            *none(kept), *_as_text(changed, "v"),
        )
    )
    names = lambda texts: [t.split()[0] for t in texts]
    found = both.groupBy("device", "nameless", "spread").transformWithStateInPandas(
        _LookUp(names(kept), names(looked_up)), ", ".join(kept + looked_up), "Append", "None"
    )
    return found.select(*_from_text(readings.schema, "r"), *_from_text(changed, "v"))


# ---- windows over arrival, closed by timers ----

#: A window stays open so long after its end, as a clock may be set back or a job move hosts.
SLACK_MS = 5_000

_SUMS = ["cnt_points", "cnt_anomalies", "cnt_vib_spikes", "t_sum", "t_n", "e_sum", "e_n"]
_LEAST = ["min_temperature", "min_signal"]
_MOST = ["max_temperature", "max_vibration", "threshold_used", "location_id", "model"]
_FIGURES = _SUMS + _LEAST + _MOST
_KINDS = {
    "cnt_points": "long", "cnt_anomalies": "long", "cnt_vib_spikes": "long", "t_sum": "double", "t_n": "long", "e_sum": "double",
    "e_n": "long", "min_temperature": "double", "min_signal": "int", "max_temperature": "double", "max_vibration": "double",
    "threshold_used": "double", "location_id": "string", "model": "string",
}
_KEYS = {"device_id": "string", "nameless": "boolean", "start_ms": "long", "end_ms": "long"}


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per device, window, location and model of each batch."""
    schema = pa.schema(
        [(c, {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[k])
         for c, k in (_KEYS | _KINDS).items()]
    )
    keys = [*_KEYS, "location_id", "model"]
    how = {"t_n": "count", "e_n": "count"} | dict.fromkeys(_LEAST, "min") | dict.fromkeys(
        [c for c in _MOST if c not in keys], "max"
    ) | dict.fromkeys([c for c in _SUMS if c not in ("t_n", "e_n")], "sum")
    for batch in batches:
        grouped = pa.Table.from_batches([batch]).group_by(keys).aggregate(list(how.items()))
        named = grouped.rename_columns([next((c for c in how if f"{c}_{how[c]}" == n), n) for n in grouped.column_names])
        yield from named.select(schema.names).cast(schema).to_batches()


def _merged(a: tuple | None, b: tuple) -> tuple:
    if a is None:
        return b
    out = []
    for name, x, y in zip(_FIGURES, a, b):
        if x is None or y is None:
            out.append(x if y is None else y)
        else:
            out.append(x + y if name in _SUMS else min(x, y) if name in _LEAST else max(x, y))
    return tuple(out)


class _Windows(StatefulProcessor):
    """State of a device: the figures of its open windows, and a timer for each."""

    def __init__(self, slack_ms: int):
        self.slack_ms = slack_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start_ms long, end_ms long", ", ".join(f"{c} {_KINDS[c]}" for c in _FIGURES))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            window = (row["start_ms"], row["end_ms"])
            before = tuple(self.open.getValue(window)) if self.open.containsKey(window) else None
            if before is None:
                self.handle.registerTimer(row["end_ms"] + self.slack_ms)
            self.open.updateValue(window, _merged(before, tuple(row[c] for c in _FIGURES)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        closed = [tuple(w) for w in self.open.keys() if w[1] + self.slack_ms <= expiredTimerInfo.getExpiryTimeInMs()]
        for window in closed:
            figures = tuple(self.open.getValue(window))
            self.open.removeKey(window)
            yield Row(**dict(zip([*_KEYS, *_FIGURES], (*key, *window, *figures))))

    def close(self) -> None:
        pass


def arrival_windows(readings: DataFrame, size: str = "1 minute", slack_ms: int = SLACK_MS) -> DataFrame:
    """Health windows over the clock: a reading counts in the window in which its micro-batch began.

    A window's timer closes it ``slack_ms`` after its end, whether or not another reading arrives; a standing query runs its
    timers at every trigger. Readings without a device form windows of their own, as they do in batch. Readings are
    combined in the task that read them, so a device sends a row per task and micro-batch, however busy it is.
    """
    stamped = readings.withColumn("arrival", now_millis()).withColumn("window", F.window("arrival", size))
    one = lambda condition: F.when(condition, 1).otherwise(0).cast("long")
    rows = stamped.select(
        F.coalesce(KEY, F.lit("")).alias("device_id"), F.col(KEY).isNull().alias("nameless"),
        F.unix_millis(F.col("window.start").cast("timestamp")).alias("start_ms"),
        F.unix_millis(F.col("window.end").cast("timestamp")).alias("end_ms"),
        F.lit(1).cast("long").alias("cnt_points"), one(is_over()).alias("cnt_anomalies"), one(is_spike()).alias("cnt_vib_spikes"),
        F.col("temperature").alias("t_sum"), F.col("temperature").alias("t_n"),
        F.col("energy_usage").alias("e_sum"), F.col("energy_usage").alias("e_n"),
        F.col("temperature").alias("min_temperature"), F.col("signal_strength").alias("min_signal"),
        F.col("temperature").alias("max_temperature"), F.col("vibration").alias("max_vibration"),
        F.col("temp_threshold").alias("threshold_used"), "location_id", "model",
    )
    partial = rows.mapInArrow(_combined, ", ".join(f"{c} {k}" for c, k in (_KEYS | _KINDS).items()))
    kinds = {"device_id": "string", "nameless": "boolean", "start_ms": "long", "end_ms": "long"} | {c: _KINDS[c] for c in _FIGURES}
    closed = partial.groupBy("device_id", "nameless").transformWithState(
        _Windows(slack_ms), ", ".join(f"{c} {k}" for c, k in kinds.items()), "Append", "ProcessingTime"
    )
    return closed.select(
        F.when(~F.col("nameless"), F.col("device_id")).alias("device_id"),
        F.timestamp_millis("start_ms").cast("timestamp_ntz").alias("window_start"),
        F.timestamp_millis("end_ms").cast("timestamp_ntz").alias("window_end"),
        "cnt_points", "cnt_anomalies", "cnt_vib_spikes",
        F.try_divide("t_sum", "t_n").alias("avg_temperature"), "min_temperature", "max_temperature",
        F.try_divide("e_sum", "e_n").alias("avg_energy_usage"), "max_vibration", "min_signal", "threshold_used",
        (F.col("max_temperature") > F.col("threshold_used")).alias("anomaly_flag"), "location_id", "model",
    ).select(*GOLD.names)


# ---- late readings, set aside ----


class _Lateness(StatefulProcessor):
    """No state of its own: the watermark is all it asks for."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        for own in rows:
            out = own.drop(columns=["spread", "until"])
            out["late"] = own["until"].to_numpy() <= watermark
            yield out

    def close(self) -> None:
        pass


def tell_late(readings: DataFrame, by: str, delay: str, size: str = "1 minute", spread: int = SPREAD) -> DataFrame:
    """``readings`` and ``late``: whether the window a reading belongs to had closed when its micro-batch began.

    The watermark is Spark's: the greatest time before this micro-batch less ``delay``. Spark drops rows behind it from
    stateful operators; here the column that carries it stays behind, so that late rows reach the operator and are marked.
    A reading without a time is never late.
    """
    timed = readings.withColumn("_by", F.col(by).cast("timestamp")).withWatermark("_by", delay)
    # Not F.window, which drops rows without a time.
    width, moment = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {size})"), F.unix_micros("_by")
    until = moment - F.pmod(moment, width) + width
    dealt = timed.select(
        F.pmod(F.xxhash64(*readings.columns), F.lit(spread)).cast("int").alias("spread"),
        F.coalesce(until, F.lit((1 << 62))).alias("until"), *_as_text(readings.schema, "r"),
    )
    told = dealt.groupBy("spread").transformWithStateInPandas(
        _Lateness(), ", ".join([*_texts(readings.schema, "r"), "late boolean"]), "Append", "EventTime"
    )
    return told.select(*_from_text(readings.schema, "r"), "late")

