"""Nearest neighbours by largest inner product over randomly rotated one-bit codes.

A vector less the centre is normalised, turned by a random rotation into ``BITS`` times as many
components, and kept as their signs, packed, with two scalars: its length and the inner product
of the unit vector with its code. From these a product with a query is estimated without
bias, and how far the estimate is off is known: by ``SURE`` standard deviations at most, but for
about one pair in a hundred.

Every row is indexed, nothing is fitted but the centre, the mean over all rows. Rows are dealt
out to shards of about ``SHARD`` rows and queries go to all of them. In a shard the exact scores
of the rows with the best estimates set a bar; all rows whose upper bound reaches it are
reranked by exact scores of the original vectors, and the best of all shards are ranked.

Defined results: NULL ids and vectors that are NULL, empty, zero or hold a NULL or non-finite
component take no part; of rows that repeat an id one takes part; shorter vectors go on with
zeros; ties go to the smaller id; an empty table gives an empty result; other columns are ignored
whatever their names. The rotation is made from a fixed seed; reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .vectors import finite, matrix, search, sharded

SHARD = 16384
BITS = 2  # of the code for each component of the vector
SURE = 2.5
TOGETHER = 64  # queries estimated at a time
CODE = "vec_id long, code binary, length float, aligned float, embedding array<double>"


def rotation(width: int) -> np.ndarray:
    """width x n: orthonormal rows that turn a vector into n components, n a multiple of 8."""
    n = -(-BITS * width // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng(13).standard_normal((n, n)))
    return (q * np.sign(np.diag(r)))[:width]


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length, and inner product of the unit vector with its code."""
    rest = vectors - centre
    length = np.sqrt((rest**2).sum(1))
    turned = (rest / np.where(length, length, 1)[:, None]) @ turn
    aligned = np.abs(turned).sum(1) / np.sqrt(turn.shape[1])
    return np.packbits(turned > 0, axis=1), length.astype(np.float32), aligned.astype(np.float32)


def participants(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part."""
    return embeddings.where(
        F.col("vec_id").isNotNull() & finite("embedding") & F.exists("embedding", lambda x: x != 0)
    ).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def mean(rows: DataFrame, width: int) -> np.ndarray:
    """The centre, rounded so that the order in which sums are added doesn't show."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width), 0
        for batch in batches:
            total += matrix(batch.column("embedding"), width).sum(0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([n])], names=["total", "n"])

    sums = rows.select("embedding").mapInArrow(added, "total array<double>, n long")
    one = sums.select(F.posexplode("total").alias("at", "x"), "n").groupBy("at").agg((F.sum("x") / F.sum("n")).alias("x"))
    return np.array([r["x"] for r in one.orderBy("at").collect()]).round(4)


def index(rows: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """The codes of all ``rows``, with the vectors for reranking, and the centre."""
    centre, turn = mean(rows, width), rotation(width)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, length, aligned = encode(matrix(batch.column("embedding"), width), centre, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(aligned), batch.column("embedding")],
                names=["vec_id", "code", "length", "aligned", "embedding"],
            )

    return settle(rows.mapInArrow(coded, CODE)), centre


@dataclass
class Shard:
    """A shard's codes as signs, their scalars, and the original vectors."""

    ids: np.ndarray
    signs: np.ndarray
    length: np.ndarray
    aligned: np.ndarray
    vectors: np.ndarray

    def best(self, queries: np.ndarray, own: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of the query, row and exact score of the k best rows of each query."""
        bits = self.signs.shape[1]
        turned = (queries @ turn).astype(np.float32)
        estimate = turned @ self.signs.T
        estimate *= self.length / (self.aligned * np.float32(np.sqrt(bits)))
        estimate += (queries @ centre).astype(np.float32)[:, None]
        off = self.length * np.sqrt(np.maximum(0, 1 - self.aligned**2)) / self.aligned * np.float32(SURE / np.sqrt(bits - 1))
        estimate[own[:, None] == self.ids] = -np.inf
        if len(self.ids) > k:
            first = np.argpartition(estimate, -k, axis=1)[:, -k:]
            exact = np.einsum("qkd,qd->qk", self.vectors[first], queries)
            exact[self.ids[first] == own[:, None]] = -np.inf
            reach = np.sqrt((queries**2).sum(1)).astype(np.float32)
            bar = exact.min(1) - 1e-5 * np.abs(exact.min(1))
            chosen = estimate + off * reach[:, None] >= bar[:, None]
            np.put_along_axis(chosen, first, True, axis=1)
        else:
            chosen = np.ones(estimate.shape, bool)
        chosen &= own[:, None] != self.ids
        query, row = np.nonzero(chosen)
        score = np.concatenate([np.zeros(0)] + [
            np.einsum("nd,nd->n", self.vectors[row[i : i + 100_000]], queries[query[i : i + 100_000]])
            for i in range(0, len(row), 100_000)
        ])
        order = np.lexsort((self.ids[row], -score, query))
        query, row, score = query[order], row[order], score[order]
        starts = np.searchsorted(query, np.arange(len(queries)))
        rank = np.arange(len(query)) - starts[query]
        return query[rank < k], row[rank < k], score[rank < k]


def nearest(rows: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of the rows with ids divisible by ``every``.

    ``rows`` as of ``participants``.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    if not size["n"]:
        return rows.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "0D AS score").limit(0)
    n_shards, width = -(-size["n"] // SHARD), size["width"]
    codes, centre = index(rows, width)
    turn = rotation(width)
    queries = (
        rows.where(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )

    def build(batch: pa.RecordBatch) -> Shard:
        packed = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        return Shard(
            batch.column("vec_id").to_numpy(),
            np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1,
            batch.column("length").to_numpy(),
            np.maximum(batch.column("aligned").to_numpy(), np.float32(1e-3)),
            matrix(batch.column("embedding"), width),
        )

    def answer(shard: Shard, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, vectors = batch.column("vec_id").to_numpy(), matrix(batch.column("embedding"), width)
        found = []
        for i in range(0, len(ids), TOGETHER):
            query, row, score = shard.best(vectors[i : i + TOGETHER], ids[i : i + TOGETHER], centre, turn, k)
            found.append((ids[i + query], shard.ids[row], score))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return search(batches, "vec_id", build, answer)

    found = sharded(codes, queries, "vec_id", n_shards).mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
