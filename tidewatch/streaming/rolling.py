"""Row-count rolling features on a stream with keyed state.

Spark has no row-count frames on streams, so each entity keeps its last ``w - 1``
rows in order in a map state of ``transformWithStateInPandas`` (RocksDB: an entity's
state is read when its rows arrive, not held in memory). The state is keyed by a
bucket of entities and mapped by entity: a call of the processor sorts and rolls the
rows of all entities of a bucket as arrays, so that its fixed cost is not paid an
entity. Keys and the columns that order rows keep their own types; a NULL entity is an
entity. A row that arrives late is rolled at its place among the kept rows and is in
the frames of all rows that arrive after it; rows that were emitted before are not
emitted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.windows import frame_stats

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, as keyed state needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


BUCKETS = 4096          # of entities
BUCKET, NO_KEY = "tw_bucket", "tw_no_key"      # Spark hands rows over as named tuples: no leading underscore
NO_ENTITY = -1          # the bucket of rows without one


def _plain(v):
    return None if pd.isna(v) else getattr(v, "item", lambda: v)()


class Roller(StatefulProcessor):
    """Rows (key, entity, ts in microseconds, value) of a bucket -> the same with the
    frame's mean, sample deviation and z-score."""

    def __init__(self, names: tuple, types: tuple, w: int, eps: float):
        self.names, self.types, self.w, self.eps = names, types, w, eps

    def init(self, handle: StatefulProcessorHandle) -> None:
        key_type, entity_type = self.types
        self.tails = handle.getMapState("tails", T.StructType([T.StructField("entity", entity_type)]), T.StructType([
            T.StructField("at", T.ArrayType(T.LongType())), T.StructField("id", T.ArrayType(key_type)),
            T.StructField("x", T.ArrayType(T.DoubleType()))]))

    def ids(self, new: pd.DataFrame) -> pd.Series:
        ids = new[self.names[2]]
        if not isinstance(self.types[0], T.IntegralType):
            return ids
        return pd.Series(pd.arrays.IntegerArray(ids.to_numpy(np.int64), new[NO_KEY].to_numpy(bool)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        entity, ts, name, value = self.names
        new = pd.concat(list(rows), ignore_index=True)
        ids = self.ids(new)
        if key[0] == NO_ENTITY:
            new[entity] = pd.Series([None] * len(new), dtype=object)
        who, entities = pd.factorize(new[entity], use_na_sentinel=False)
        entities = [(_plain(e),) for e in entities]
        frame = pd.DataFrame({"who": who, "at": new[ts].astype("int64"), "id": ids, "x": new[value].astype("float64"),
                              "new": np.arange(len(new))})
        kept = [(i, t) for i, e in enumerate(entities) if (t := self.tails.getValue(e))]
        if kept:
            old = pd.DataFrame({
                "who": np.repeat([i for i, _ in kept], [len(t[0]) for _, t in kept]),
                "at": np.concatenate([t[0] for _, t in kept]),
                "id": pd.Series([v for _, t in kept for v in t[1]], dtype=ids.dtype),
                "x": np.concatenate([t[2] for _, t in kept]), "new": -1})
            frame = pd.concat([old, frame], ignore_index=True)
        frame = frame.sort_values(["who", "at", "id"], kind="mergesort").reset_index(drop=True)
        ends = np.cumsum(np.bincount(frame["who"]))
        place = np.arange(len(frame)) - np.concatenate([[0], ends[:-1]])[frame["who"]]
        self.keep(frame, place, ends, entities)
        x, out = frame["x"].to_numpy(), (frame["new"] >= 0).to_numpy()
        n, mean, m2 = frame_stats(np.nan_to_num(x, posinf=0.0, neginf=0.0), np.isfinite(x), self.w, place)
        x, n, mean, m2 = x[out], n[out], mean[out], m2[out]
        with np.errstate(all="ignore"):
            std = np.where(n < 2, np.nan, np.sqrt(m2 / (n - 1)))
        at = frame["new"].to_numpy()[out]
        yield pd.DataFrame({name: ids.iloc[at].array, entity: new[entity].iloc[at].array, value: x,
                            f"{value}_rolling_mean": mean, f"{value}_rolling_std": std,
                            f"{value}_zscore": (x - mean) / (std + self.eps)})

    def keep(self, frame: pd.DataFrame, place: np.ndarray, ends: np.ndarray, entities: list) -> None:
        """The last ``w - 1`` rows of each entity become its state."""
        if self.w < 2:
            return
        first = np.maximum(np.concatenate([[0], ends[:-1]]), ends - (self.w - 1))
        at, ids, x = frame["at"].to_numpy(), frame["id"].array, frame["x"].to_numpy()
        for e, lo, hi in zip(entities, first.tolist(), ends.tolist()):
            self.tails.updateValue(e, (at[lo:hi].tolist(), [_plain(i) for i in ids[lo:hi]], x[lo:hi].tolist()))

    def close(self) -> None:
        pass


def rolling_stream(stream: DataFrame, entity: str, ts: str, key: str, value: str, w: int,
                   eps: float = 1e-8, buckets: int = BUCKETS) -> DataFrame:
    """(key, entity, value, rolling mean, std and z-score of ``value``) over the last
    ``w`` rows of each entity by (``ts``, ``key``). Start it inside ``rocksdb_state``.
    ``buckets`` must stay the same over a checkpoint's life."""
    fields = {f.name: f.dataType for f in stream.schema.fields}
    stats = [f"{value}_rolling_mean", f"{value}_rolling_std", f"{value}_zscore"]
    out = T.StructType([T.StructField(key, fields[key]), T.StructField(entity, fields[entity]),
                        *[T.StructField(c, T.DoubleType()) for c in (value, *stats)]])

    def whole(c: str):      # pandas makes whole numbers beside nulls inexact: a bucket and a flag tell the nulls
        return F.coalesce(F.col(c), F.lit(0).cast(fields[c])) if isinstance(fields[c], T.IntegralType) else F.col(c)

    bucket = F.when(F.col(entity).isNull(), F.lit(NO_ENTITY)).otherwise(F.pmod(F.xxhash64(entity), F.lit(buckets)))
    src = stream.select(whole(key).alias(key), whole(entity).alias(entity), F.unix_micros(F.col(ts).cast("timestamp")).alias(ts),
                        F.col(value).cast("double").alias(value), F.col(key).isNull().alias(NO_KEY),
                        bucket.cast("int").alias(BUCKET))
    return src.groupBy(BUCKET).transformWithStateInPandas(
        Roller((entity, ts, key, value), (fields[key], fields[entity]), w, eps), out, "append", "none")
