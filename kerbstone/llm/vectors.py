"""What the two vector operators share: which vectors count, matrices from Arrow, sharded search.

A search deals the indexed rows out to shards by a hash of their id, and every query to all
shards. Within a task, rows of a shard come before the queries, so that a shard's index is built
once, from a bounded number of rows, and the queries stream past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The rows as doubles, zeros behind shorter ones."""
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def sharded(rows: DataFrame, queries: DataFrame, key: str, n_shards: int) -> DataFrame:
    """``rows`` once, each in its shard, and ``queries`` once in every shard, in search order.

    Both have the column ``key``; columns that one of them lacks are NULL there. Rows of a shard
    come first (``query`` is false), and of rows with equal keys the smallest by all columns.
    """
    placed = rows.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(n_shards).cast("long"))).withColumn("query", F.lit(False))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long")))
    asked = queries.withColumn("shard", every).withColumn("query", F.lit(True))
    both = placed.unionByName(asked, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in ("shard", "query", key)]
    return both.repartition("shard").sortWithinPartitions("shard", "query", key, *rest)


def search(
    batches: Iterator[pa.RecordBatch],
    key: str,
    build: Callable[[pa.RecordBatch], Any],
    answer: Callable[[Any, pa.RecordBatch], pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """Runs ``answer`` with a shard's index on the queries that follow the shard's rows."""
    shard, parts, index = None, [], None
    for this, is_query, piece in _runs(batches):
        if this != shard:
            shard, parts, index = this, [], None
        if not is_query:
            parts.append(piece)
            continue
        if index is None and parts:
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            keys = whole.column(key).to_numpy()
            fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
            index = build(whole.filter(pa.array(fresh)))
            parts = []
        if index is not None:
            yield answer(index, piece)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column("shard").to_numpy()
        query = batch.column("query").to_numpy(zero_copy_only=False)
        change = np.flatnonzero((shard[1:] != shard[:-1]) | (query[1:] != query[:-1])) + 1
        for start, stop in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            yield int(shard[start]), bool(query[start]), batch.slice(start, stop - start)
