"""Hard negatives by cover trees over norm-augmented candidates.

An anchor's positives are its best rows of the same label, a positive's hard negatives the best
rows of other labels whose score lies in a window below the positive's. Scores are inner
products of vectors of whole numbers.

Rows are dealt out to shards of about ``SHARD`` rows, and each task builds a cover tree for its
shard. One more component makes all candidates equally long, so that the largest inner product is
the least distance. A node's children cover its points within ``SHRINK`` of its own radius; the
radius kept is the largest distance of the points from the centre, so a point's score differs
from the centre's by the anchor's length times the radius at most. Where covering no longer
brings points together (a node would have more than a ``PAYS``-th of its points as children),
its points are a leaf.

Anchors descend best bound first. Nodes whose bounds lie outside all of an anchor's windows, or
below what is found already, are skipped; leaves are verified by exact products. The best of all
shards are then ranked.

Defined results: rows with a NULL id or label, without a vector, or with a NULL or non-finite
component take no part; of rows that repeat an id one takes part; shorter vectors go on with
zeros; ties go to the smaller id; an empty table gives an empty result; scores are exact
below 2^53; other columns are ignored whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .vectors import finite, matrix, search, sharded

SHARD = 4096
LEAF = 32
SHRINK = 0.6
PAYS = 8
SCALE = 256.0


# --- the tree -------------------------------------------------------------------------------


@dataclass
class Node:
    centre: int  # row
    radius: float
    children: list[int] = field(default_factory=list)  # numbers of nodes
    rows: np.ndarray | None = None  # of a leaf


class CoverTree:
    """A shard's ids, labels and whole-number vectors, and the nodes over them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        squares = (self.vectors**2).sum(1)
        self.points = np.column_stack((self.vectors, np.sqrt(squares.max() - squares)))
        self.nodes: list[Node] = []
        self._grow(np.arange(len(ids)), int(squares.argmin()))
        self.centres = self.vectors[[n.centre for n in self.nodes]]
        # A little more than measured, for rounding.
        self.radii = np.array([n.radius for n in self.nodes]) * (1 + 1e-9) + 1e-6

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[centre]) ** 2).sum(1))

    def _grow(self, rows: np.ndarray, centre: int) -> None:
        """Nodes level by level; a node's centre is the centre of its first child."""
        waiting = [(rows, centre, None)]
        for rows, centre, parent in waiting:  # grows while it is read
            away = self._distances(rows, centre)
            node = Node(centre, float(away.max()))
            if parent is not None:
                self.nodes[parent].children.append(len(self.nodes))
            parts = self._covered(rows, centre, away, node.radius * SHRINK) if len(rows) > LEAF and node.radius else None
            if parts is None:
                node.rows = np.sort(rows)
            else:
                waiting += [(*part, len(self.nodes)) for part in parts]
            self.nodes.append(node)

    def _covered(self, rows: np.ndarray, centre: int, away: np.ndarray, within: float) -> list[tuple[np.ndarray, int]] | None:
        """The rows by centres that cover them; None if that takes too many centres."""
        parts: list[tuple[np.ndarray, int]] = []
        most = len(rows) // PAYS
        while len(rows):
            near = away <= within
            if not near.any():  # the next centre: a point farthest from the last
                centre = int(rows[away.argmax()])
                away = self._distances(rows, centre)
                continue
            parts.append((rows[near], centre))
            if len(parts) > most:
                return None
            rows, away = rows[~near], away[~near]
            if len(rows):
                centre = int(rows[away.argmax()])
                away = self._distances(rows, centre)
        return parts

    def best(self, vector: np.ndarray, chosen: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window low <= score <= high the rows and scores of the k best chosen rows."""
        reach = float(np.sqrt(vector @ vector))
        middle, spread = self.centres @ vector, self.radii * reach
        upper, lower = middle + spread, middle - spread
        found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in low]
        least = low.astype(np.float64).copy()  # what a row must have to matter
        heap = [(-upper[0], 0)]
        while heap:
            bound, number = heapq.heappop(heap)
            wanted = np.flatnonzero((-bound >= least) & (lower[number] <= high))
            if not len(wanted):
                continue
            node = self.nodes[number]
            if node.rows is None:
                for child in node.children:
                    heapq.heappush(heap, (max(bound, -upper[child]), child))
                continue
            rows = node.rows[chosen[node.rows]]
            scores = self.vectors[rows] @ vector
            for w in wanted:
                inside = (scores >= least[w]) & (scores <= high[w])
                if inside.any():
                    found[w] = self._first(*(np.concatenate(x) for x in zip(found[w], (rows[inside], scores[inside]))), k)
                    if len(found[w][0]) == k:
                        least[w] = found[w][1][-1]  # equal scores may still win by their id
        return found

    @staticmethod
    def _first(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((rows, -scores))[:k]  # rows are in the order of their ids
        return rows[order], scores[order]


# --- the operator ---------------------------------------------------------------------------


def candidates(embeddings: DataFrame, moved: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label, embedding of the rows that take part; every ``moved``-th id gets the next label."""
    label = F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )


def hard_negatives(rows: DataFrame, every: int = 100, k: int = 5, share: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; a positive's negatives score from
    ``share`` percent of its own score up to it. ``rows`` as of ``candidates``.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    n_shards, width = max(1, -(-size["n"] // SHARD)), size["width"] or 0
    anchors = settle(
        rows.where(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "embedding")).alias("row"))
        .select("vec_id", "row.*")
    )
    alike = settle(_searched(rows, anchors.withColumn("positives", F.lit(None).cast(POSITIVES)), n_shards, width, k, share))
    positives = (
        _ranked(alike, ["anchor_id"], k).groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("found_id").alias("id"), "score"))).alias("positives"))
    )
    others = _searched(rows, anchors.join(positives, "vec_id"), n_shards, width, k, share)
    return _ranked(others, ["anchor_id", "positive_id"], k).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


POSITIVES = "array<struct<id: bigint, score: bigint>>"
FOUND = ("anchor_id", "positive_id", "positive_score", "found_id", "score")


def _ranked(found: DataFrame, of: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(rows: DataFrame, anchors: DataFrame, n_shards: int, width: int, k: int, share: int) -> DataFrame:
    """The best rows of every shard: of the anchor's label, or per positive of the others."""

    def build(batch: pa.RecordBatch) -> CoverTree:
        return CoverTree(
            batch.column("vec_id").to_numpy(),
            batch.column("label").to_numpy(),
            np.floor(SCALE * matrix(batch.column("embedding"), width)),
        )

    def answer(tree: CoverTree, batch: pa.RecordBatch) -> pa.RecordBatch:
        found: list[tuple] = []
        vectors = np.floor(SCALE * matrix(batch.column("embedding"), width))
        for vector, anchor, label, positives in zip(
            vectors, *(batch.column(c).to_pylist() for c in ("vec_id", "label", "positives"))
        ):
            if positives is None:
                chosen = (tree.labels == label) & (tree.ids != anchor)
                windows, limits = [(None, None)], (np.array([-np.inf]), np.array([np.inf]))
            else:
                chosen = tree.labels != label
                windows = [(p["id"], p["score"]) for p in positives]
                scores = np.array([p["score"] for p in positives])
                limits = (np.ceil(share * scores / 100), scores)  # 100 * score >= share * positive
            for (positive, above), (at, score) in zip(windows, tree.best(vector, chosen, *limits, k)):
                found += [(anchor, positive, above, *x) for x in zip(tree.ids[at].tolist(), score.astype(np.int64).tolist())]
        columns = zip(*found) if found else ((),) * len(FOUND)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return search(batches, "vec_id", build, answer)

    # The rows' own labels and vectors are all that a tree needs; queries bring their positives.
    return sharded(rows, anchors, "vec_id", n_shards).mapInArrow(run, ", ".join(f"{c} long" for c in FOUND))
