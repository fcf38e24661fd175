"""T1 with W1, W3, W5, W9-W11: features of the rows of a new period, without reading the history again.

A stream keeps for each entity what its next rows need: the last ``max(lags, windows)`` values, the
number of rows and of changes, the row of the last change and the last period.  A new period costs
its own rows and the state they meet, however long the history is.

A group of the stream is not one entity but a bucket of them, by hash: Spark hands groups to Python one
by one, at a few milliseconds each, which for millions of entities is far more than their features.
The entities of a bucket are worked out together, as arrays, and their state is one value (Arrow, LZ4).
So a row of one entity reads and writes the state of its whole bucket, and a task holds the rows that one
batch has for a bucket.  More entities want more ``buckets``; a checkpoint keeps the number it began with.
State grows with the entities, so on a cluster it belongs in RocksDB
(``spark.sql.streaming.stateStore.providerClass``), beside the heap.

Rows of an entity are taken by period (those that arrive together in order of period, then of value),
so the result is that of the batch windows in ``operators/features.py`` and
``operators/transitions.py`` as long as periods arrive in order.  A row whose period is not after the
entity's last one cannot be placed any more: it is given out with ``atrasada`` true and no features, and
leaves the state as it is.  So is a row without a period.  Rows without an entity form one entity, as they do in a window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..constants import ENTITY, PERIOD, ROLLING_WINDOWS, STATUS_LAGS, TARGET

BUCKETS = 1024
_STATE = "buckets int, entities binary"
_NEVER, _NO_PERIOD = -2**40, 2**40  # days before and after every date
_COUNTERS = ("houve_mudanca", "num_mudancas_anteriores", "meses_desde_ultima_mudanca", "posicao_temporal")


class _Held(NamedTuple):
    """The state of a bucket's entities, one place each; ``history`` is filled from the right, NaN where there is no value."""

    entity: pd.Series
    missing: np.ndarray  # the entity is NULL
    period: np.ndarray
    n: np.ndarray
    changes: np.ndarray
    last_change: np.ndarray
    history: np.ndarray


def _packed(held: _Held) -> bytes:
    width = held.history.shape[1]
    columns = {c: pa.array(v) for c, v in zip(_Held._fields[:-1], held[:-1], strict=True)}
    columns["history"] = pa.FixedSizeListArray.from_arrays(pa.array(held.history.ravel()), width)
    table, sink = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> _Held:
    table = pa.ipc.open_stream(data).read_all()
    width = table.schema.field("history").type.list_size
    history = table["history"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return _Held(table["entity"].to_pandas(), *(table[c].to_numpy() for c in _Held._fields[1:-1]), history)


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = a + b
    of_b = total - a
    return total, (a - (total - of_b)) + (b - of_b)


def _sum(terms: list[np.ndarray]) -> np.ndarray:
    """Sums over the arrays, place by place, each rounded once as by ``math.fsum``."""
    high = low = doubt = np.zeros(len(terms[0]))
    for term in terms:
        high, off = _two_sum(high, term)
        low, lost = _two_sum(low, off)
        doubt = doubt + np.abs(lost)
    least, most = np.nextafter(low - 2 * doubt, -np.inf), np.nextafter(low + 2 * doubt, np.inf)
    total = np.where(np.isfinite(high), high + low, high)
    for i in np.flatnonzero((doubt > 0) & (high + least != high + most)):  # as good as never
        total[i] = math.fsum(term[i] for term in terms)
    return total


def _mean_std(window: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of the values that are there (not NaN); 0 where there are too few."""
    there = [~np.isnan(v) for v in window]
    count = np.sum(there, axis=0)
    mean = _sum([np.where(t, v, 0.0) for t, v in zip(there, window, strict=True)]) / np.maximum(count, 1)
    squares = _sum([np.where(t, (v - mean) ** 2, 0.0) for t, v in zip(there, window, strict=True)])
    return mean, np.where(count > 1, np.sqrt(squares / np.maximum(count - 1, 1)), 0.0)


def _names(col: str, lags: list[int], windows: list[int]) -> list[tuple[str, str]]:
    rolled = [(f"{col}_rolling_{what}_{w}", "double") for w in windows for what in ("mean", "std")]
    return [*((f"{col}_lag_{k}", "double") for k in lags), *rolled, *((c, "long") for c in _COUNTERS),
            ("taxa_mudanca_empresa", "double"), ("atrasada", "boolean")]


def _joined(held: _Held | None, entity: pd.Series, missing: np.ndarray, width: int) -> tuple[_Held, np.ndarray]:
    """State with a place for every entity, of the state and of the rows, and the place of each row."""
    known = len(held.missing) if held else 0
    if held:
        entity, missing = pd.concat([held.entity, entity], ignore_index=True), np.concatenate([held.missing, missing])
    _, first, place = np.unique(pd.factorize(entity)[0].astype("int64") * 2 + missing, return_index=True, return_inverse=True)
    size = len(first)
    out = _Held(entity.iloc[first], missing[first], np.full(size, _NEVER), *np.zeros((3, size), "int64"), np.full((size, width), np.nan))
    if held:
        for new, old in zip(out[2:-1], held[2:-1], strict=True):
            new[place[:known]] = old
        kept = min(width, held.history.shape[1])
        out.history[place[:known], width - kept:] = held.history[:, held.history.shape[1] - kept:]
    return out, place[known:]


def _advance(held: _Held, place: np.ndarray, period: np.ndarray, value: np.ndarray, lags: list[int],
             windows: list[int]) -> list[np.ndarray]:
    """The features of rows in order of (place, period); brings the state of their entities up to date."""
    width = held.history.shape[1]
    touched, rows = np.unique(place, return_counts=True)
    rank, ends = np.repeat(np.arange(len(touched)), rows), np.cumsum(rows)
    begins = ends - rows
    at = np.arange(len(place))
    # one array: each entity's held values, then its new ones
    values, spot = np.empty(len(place) + width * len(touched)), at + width * (rank + 1)
    values[(begins + width * np.arange(len(touched)))[:, None] + np.arange(width)] = held.history[touched]
    values[spot] = value
    back = [values[spot - k] for k in range(width + 1)]

    n = held.n[place] + at - begins[rank] + 1
    change = (~np.isnan(back[1]) & (back[1] != value)).astype("int64")
    counted = np.cumsum(change)
    changes = held.changes[place] + counted - (counted[begins] - change[begins])[rank]
    latest = np.maximum.accumulate(np.where(change == 1, at, -1))
    last_change = np.where(latest >= begins[rank], n[latest], held.last_change[place])
    features = [back[k] for k in lags]
    for w in windows:
        features += _mean_std(back[:w])
    features += [change, changes, n - last_change, n - 1, changes / n]

    for new, old in ((period, held.period), (n, held.n), (changes, held.changes), (last_change, held.last_change)):
        old[touched] = new[ends - 1]
    held.history[touched] = values[(ends + width * np.arange(1, len(touched) + 1))[:, None] + np.arange(-width, 0)]
    return features


def stateful_features(stream: DataFrame, col: str = TARGET, lags: list[int] = STATUS_LAGS, windows: list[int] = ROLLING_WINDOWS,
                      entity: str = ENTITY, period: str = PERIOD, buckets: int = BUCKETS) -> DataFrame:
    """A streaming (entity, period, ``col``) frame with its lags, rolling statistics and change history."""
    names = _names(col, lags, windows)
    width = max([1, *lags, *windows])

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = None
        if state.exists:
            begun, data = state.get
            if begun != buckets:
                raise ValueError(f"the checkpoint has {begun} buckets, not {buckets}")
            held = _unpacked(bytes(data))
        frame = pd.concat(list(frames), ignore_index=True)
        held, place = _joined(held, frame["entity"], frame["missing"].to_numpy("bool"), width)
        days, value = frame["days"].to_numpy("float64"), frame["value"].to_numpy("float64")
        when = np.where(np.isnan(days), _NO_PERIOD, days).astype("int64")
        order = np.lexsort((value, when, place))  # NaN comes last
        place, when, value = place[order], when[order], value[order]
        again = np.concatenate([[False], (place[1:] == place[:-1]) & (when[1:] == when[:-1])])
        placed = ~again & (when < _NO_PERIOD) & (when > held.period[place])
        with np.errstate(all="ignore"):
            own = _advance(held, place[placed], when[placed], value[placed], lags, windows)
        state.update((buckets, _packed(held)))
        out = {"entity": frame["entity"].to_numpy()[order], "missing": frame["missing"].to_numpy("bool")[order],
               "days": days[order], "value": value}
        for k, feature in enumerate(own):
            out[f"f{k}"] = np.full(len(order), np.nan)
            out[f"f{k}"][placed] = feature
        yield pd.DataFrame({**out, "late": ~placed})

    key, key_type = stream[entity], stream.schema[entity].dataType
    # whole numbers stay what they are in pandas only where there is no NULL
    sent = F.coalesce(key, F.lit(0).cast(key_type)) if isinstance(key_type, T.NumericType) else key
    own = stream.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), sent.alias("entity"),
                        key.isNull().alias("missing"), F.unix_date(stream[period].cast("date")).alias("days"),
                        stream[col].cast("double").alias("value"))
    given = T.StructType([T.StructField("entity", key_type), T.StructField("missing", T.BooleanType())])
    for c in ("days", "value", *(f"f{k}" for k in range(len(names) - 1))):
        given = given.add(c, T.DoubleType())
    given = given.add("late", T.BooleanType())
    found = own.groupBy("bucket").applyInPandasWithState(update, given, _STATE, "append", GroupStateTimeout.NoTimeout)
    return found.select(F.when(~F.col("missing"), F.col("entity")).alias(entity),
                        F.date_from_unix_date(F.col("days").cast("int")).alias(period), F.col("value").alias(col),
                        *(F.col(f"f{k}").cast(kind).alias(name) for k, (name, kind) in enumerate(names[:-1])),
                        F.col("late").alias(names[-1][0]))


def features_of_new_files(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, **settings) -> None:
    """Run over every Parquet file of ``source`` not yet seen, add the rows with their features to ``target``, then stop.

    All new files make one micro-batch, so their order on disk plays no part; a batch that is
    run again after a crash starts from the state before it and replaces its own files.
    """
    stream = spark.readStream.schema(schema).option("maxFileAge", "3650d").parquet(source)
    q = (stateful_features(stream, **settings).writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()
