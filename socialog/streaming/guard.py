"""Redelivery guard without a time limit.

The ids that were delivered are kept as intervals, by cuts of the id range: a cut that
is delivered whole is one interval however many ids it holds, and a redelivery is
caught however late it comes. Ids without gaps (of all shards together, or of each
shard where its ids are counted on their own) keep the state smallest; ids that never
come keep two numbers a gap. A cut is a state row of its own, so ids of one hour
do not meet in one task and a checkpoint writes only the cuts that changed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors don't need this package

CUT_BITS = 16  # low bits of the ids of a cut
INTERVALS = "starts array<bigint>, ends array<bigint>"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Settings of the state store for streams that start within; put back after."""
    before = {key: spark.conf.get(key, None) for key in STORE}
    try:
        for key, value in STORE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def covered(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each id lies in one of the sorted intervals (both ends included)."""
    if not len(starts):
        return np.zeros(len(ids), bool)
    at = np.searchsorted(starts, ids, "right") - 1
    return (at >= 0) & (ids <= ends[at])


def joined(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with new distinct ``ids``; neighbours become one."""
    starts, ends = np.concatenate([starts, ids]), np.concatenate([ends, ids])
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    apart = starts[1:] > ends[:-1] + 1
    return starts[np.append(True, apart)], ends[np.append(apart, True)]


class _Guard(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.delivered = handle.getValueState("delivered", INTERVALS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.delivered.get() if self.delivered.exists() else ([], [])
        starts, ends = (np.array(x, np.int64) for x in held)
        before = len(starts), ends.sum()
        for some in rows:
            if some["id"].isna().all():
                yield some
                continue
            ids = some["id"].to_numpy(np.int64)
            fresh = ~covered(ids, starts, ends) & ~some["id"].duplicated().to_numpy()
            if fresh.any():
                starts, ends = joined(ids[fresh], starts, ends)
                yield some[fresh]
        if (len(starts), ends.sum()) != before:
            self.delivered.update((starts.tolist(), ends.tolist()))

    def close(self) -> None:
        pass


def once_ever(events: DataFrame, by: Sequence[str] = (), cut_bits: int = CUT_BITS) -> DataFrame:
    """Each event of a stream once, however late it is delivered again.

    ``by`` names columns whose ids are counted on their own, such as ``shard_index``.
    Events without an id all pass. Start the stream within ``state_store``.
    """
    keys = {f"_{name}": F.col(name) for name in by} | {"_cut": F.shiftright("id", cut_bits)}
    return (
        events.withColumns(keys)
        .groupBy(*keys)
        .transformWithStateInPandas(
            _Guard(), outputStructType=events.schema, outputMode="Append", timeMode="None"
        )
    )


def state_rows(spark: SparkSession, position: str) -> DataFrame:
    """What the guard of a checkpoint folder holds: a row for each cut with its intervals."""
    reader = spark.read.format("statestore").option("stateVarName", "delivered")
    return reader.load(position).select("key.*", "value.*")
