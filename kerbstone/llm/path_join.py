"""Near-duplicate documents by a chosen-path set similarity join.

1. Every text becomes its set of word shingles, a digest of the set, and minwise tokens: for
   each of ``POSITIONS`` hash functions the least hash over the set. Documents with equal sets
   form one class; only classes are joined, so copies are never paired.
2. Each of ``TREES`` independent trees puts a class into the node of one of its minwise tokens.
   Two sets share such a token with the probability of their similarity, so similar ones stay
   together. Nodes with more than ``SMALL`` classes are first compared in random blocks that
   share one class; those that this makes one component are done. The rest branch: a node's
   path chooses one or two further positions, and its classes go to the children of their
   tokens there.
3. In small nodes all pairs are compared: by their minwise tokens, and where these agree often
   enough, exactly on whole sets. Groups that several trees find alike are compared once, and
   only spanning links are returned.
4. Links join classes into components.

A pair of similarity J in small nodes of the first level is missed with probability
(1 - J) ** TREES (2e-7 at 0.85, 3e-6 at 0.8). Where nodes branch, the chance to stay together
through any number of levels is at least 0.76 a tree at 0.85 (0.63 at 0.8), so 1e-5 (4e-4) is
missed. Nodes that are still wide after ``DEPTH`` levels are compared whole, block against
block, by as many groups as there are pairs of blocks.

Defined results: NULL text and texts without words have an empty set and no links; equal
texts and repeated rows share a class; the component of rows whose ids are all NULL is NULL
and such rows are not kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_whole, settle, text_or_empty
from .graph import components
from .tasks import WordHashes, text_chunks, whole_groups

SHINGLE = 5
POSITIONS = 48
TREES = 8
SMALL = 2048
BLOCK = 256
DEPTH = 12
HEAVY = 2048  # shingles; a larger set counts as several classes where sizes are bounded
COLUMNS = 8192  # of the matrix that is multiplied at once

_RANDOM = np.random.default_rng(5).integers(0, 2**63, (2, POSITIONS), dtype=np.int64).astype(np.uint64)
_XOR, _ODD = _RANDOM[0], _RANDOM[1] * np.uint64(2) + np.uint64(1)
_WEIGHTS = np.random.default_rng(6).integers(0, 2**63, SHINGLE, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


# --- sets ------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def shingle_sets(texts: list[bytes | None], word_hashes: WordHashes) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles."""
    found = [t.lower().split() if t else [] for t in texts]
    lengths = [len(words) for words in found]
    total = sum(lengths)
    words = np.fromiter(map(word_hashes.__getitem__, chain.from_iterable(found)), np.uint64, total)
    word_hashes.keep_bounded()
    runs = np.zeros(max(0, total - SHINGLE + 1), np.uint64)
    for i, weight in enumerate(_WEIGHTS):
        runs += words[i : i + len(runs)] * weight
    runs = _mix(runs)
    sets, at = [], 0
    for n in lengths:
        if n >= SHINGLE:
            own = np.sort(runs[at : at + n - SHINGLE + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            short = words[at : at + n] * _WEIGHTS[:n]
            own = _mix(np.array([short.sum() + np.uint64(n)])) if n else short
        sets.append(own)
        at += n
    return sets


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, digests, tokens = [], [], []
        for texts in text_chunks(batch.column("text")):
            sets = shingle_sets(texts, hashes)
            sizes += [len(s) for s in sets]
            digests += [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            full = [s for s in sets if len(s)]
            rows = iter(_minwise(full) if full else ())
            tokens += [next(rows) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(tokens, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_key", "n_shingles", "class", "tokens"],
        )


def _minwise(sets: list[np.ndarray]) -> np.ndarray:
    """A row of least hashes for each set."""
    every = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    rows = np.empty((len(sets), POSITIONS), np.uint64)
    for k in range(POSITIONS):
        rows[:, k] = np.minimum.reduceat((every ^ _XOR[k]) * _ODD[k], starts)
    return rows.view(np.int64)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        classes = batch.column("class")
        at = 0
        for texts in text_chunks(batch.column("text")):
            sets = [s.tobytes() for s in shingle_sets(texts, hashes)]
            yield pa.RecordBatch.from_arrays(
                [classes.slice(at, len(sets)), pa.array(sets, pa.binary())], names=["class", "set"]
            )
            at += len(sets)


# --- comparisons in tasks ----------------------------------------------------------------


def _reached(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the least row of its component."""
    n = len(linked)
    near = linked | np.eye(n, dtype=bool)
    root = np.arange(n)
    while True:
        least = np.where(near, root[None, :], n).min(1)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def least_agreement(percent: int) -> int:
    """Tokens a pair at the threshold shares at least, up to 4.5 standard deviations (3e-5)."""
    share = percent / 100
    return int(POSITIONS * share - 4.5 * (POSITIONS * share * (1 - share)) ** 0.5)


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Small nodes to groups of classes whose minwise tokens agree often enough.

    Pairs that are in one component already have nothing to add.
    """
    least = least_agreement(percent)
    for node in whole_groups(batches, "node"):
        classes = node.column("class").to_pylist()
        sizes = node.column("n_shingles").to_numpy(zero_copy_only=False)
        tokens = np.array(node.column("tokens").to_pylist(), np.int64)
        agree = np.zeros((len(classes),) * 2, np.uint8)
        for column in tokens.T:
            agree += column[:, None] == column[None, :]
        close = 100 * np.minimum(sizes[:, None], sizes) >= percent * np.maximum(sizes[:, None], sizes)
        known = node.column("root").dictionary_encode().indices.to_numpy()
        root = _reached((agree >= least) & close & (known[:, None] != known))
        groups, members = [], []
        for first in np.flatnonzero(np.bincount(root) > 1):
            own = sorted(classes[i] for i in np.flatnonzero(root == first))
            groups += [hashlib.blake2b(b"".join(own), digest_size=16).digest()] * len(own)
            members += own
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.binary()), pa.array(members, pa.binary())], names=["group", "class"]
        )


def links_within(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of the pairs of sets with 100 * intersection >= percent * union."""
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    found, column = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(column) > 1
    number = np.cumsum(often) - 1
    rows, column = rows[often[column]], number[column[often[column]]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    shared = np.zeros((len(sets),) * 2, np.float64)
    for first in range(0, int(often.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + COLUMNS))
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[rows[lo:hi], column[lo:hi] - first] = 1
        shared += block @ block.T
    union = sizes[:, None] + sizes - shared
    return (100 * shared >= percent * union) & (shared > 0)


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Groups of whole sets to spanning links (a, b) of their components."""
    for group in whole_groups(batches, "group"):
        own = dict(zip(group.column("class").to_pylist(), group.column("set").to_pylist()))
        classes = sorted(own)
        root = _reached(links_within([np.frombuffer(own[c], np.uint64) for c in classes], percent))
        pairs = [(classes[r], classes[i]) for i, r in enumerate(root) if r != i]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
            names=["a", "b"],
        )


# --- the join ----------------------------------------------------------------------------


def _links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact links in each group (group, class)."""
    return settle(
        groups.join(sets, "class")
        .repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(lambda b: _linked(b, percent), "a binary, b binary")
    )


def _sized(nodes: DataFrame) -> DataFrame:
    """Nodes with ``many``, how many classes they have by weight; those of one class go."""
    weight = F.greatest(F.lit(1), F.col("n_shingles") / HEAVY)
    many = nodes.groupBy("node").agg(F.sum(weight).alias("many"), F.count("*").alias("n"))
    return settle(nodes.join(many.where("n > 1").drop("n"), "node"))


def _children() -> Column:
    """The nodes a class goes to from a wide node: a second one for every other path."""
    shift = 1 + F.pmod(F.xxhash64("node", F.lit(1)), F.lit(POSITIONS - 1))
    place = F.pmod(F.xxhash64("node", F.lit(0)), F.lit(POSITIONS))
    other = F.pmod(place + shift, F.lit(POSITIONS))
    first = F.xxhash64("node", place, F.get("tokens", place.cast("int")))
    second = F.xxhash64("node", other, F.get("tokens", other.cast("int")))
    twice = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(2)) == 0
    return F.when(twice, F.array(first, second)).otherwise(F.array(first))


def _blocks(nodes: DataFrame, pairs: bool) -> DataFrame:
    """Wide nodes as groups of blocks: every pair of blocks, or blocks that share one class."""
    number = F.ceil(F.col("many") / BLOCK)
    every = F.sequence(F.lit(0), (number - 1).cast("int"))
    own = F.pmod(F.xxhash64("class", "node"), number).cast("int")
    if pairs:
        blocks = nodes.select("node", "class", own.alias("own"), F.explode(every).alias("other"))
        key = (F.least("own", "other"), F.greatest("own", "other"))
    else:
        shared = nodes.groupBy("node").agg(F.min("class").alias("shared"))
        mine = F.when(F.col("class") == F.col("shared"), every).otherwise(F.array(own))
        blocks = nodes.join(shared, "node").select("node", "class", F.explode(mine).alias("own"))
        key = (F.col("own"),)
    return blocks.select(F.unhex(F.md5(F.concat_ws(":", "node", *key))).alias("group"), "class")


def _open(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes whose classes aren't all in one component already."""
    placed = nodes.join(roots.withColumnRenamed("node", "class"), "class", "left")
    root = F.coalesce("root", "class")
    mixed = placed.groupBy("node").agg((F.min(root) != F.max(root)).alias("mixed")).where("mixed")
    return nodes.join(mixed.select("node"), "node", "left_semi")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: a row for each row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    text_key = F.unhex(F.md5(text_or_empty()))
    texts = docs.select("doc_id", text_key.alias("text_key"), F.col("text").cast("binary").alias("text"))
    rows = settle(
        texts.mapInArrow(
            _described,
            f"doc_id {id_type}, text_key binary, n_shingles long, class binary, tokens array<long>",
        )
    )
    classes = settle(
        rows.where("n_shingles > 0")
        .groupBy("class", "n_shingles", "tokens")
        .agg(F.min("text_key").alias("text_key"), F.min("doc_id").alias("least_id"))
    )
    trees = F.array(
        *(F.xxhash64(F.lit(t), F.get("tokens", F.lit(t))) for t in range(TREES))
    )
    nodes = _sized(classes.select("class", "n_shingles", "tokens", F.explode(trees).alias("node")))
    compared = nodes.select("class").distinct().join(classes.select("class", "text_key"), "class")
    sets = settle(
        texts.select("text_key", "text")
        .join(compared, "text_key")
        .groupBy("class")
        .agg(F.first("text").alias("text"))
        .mapInArrow(_set_rows, "class binary, set binary")
    )
    wide = nodes.where(F.col("many") > SMALL)
    links = _links(_blocks(wide, pairs=False), sets, percent)
    roots = components(links)
    small = nodes.where(F.col("many") <= SMALL)
    wide = settle(_open(wide, roots))
    for _ in range(DEPTH):
        if wide.isEmpty():
            break
        below = _open(
            _sized(wide.select("class", "n_shingles", "tokens", F.explode(_children()).alias("node"))),
            roots,
        )
        small = small.unionByName(below.where(F.col("many") <= SMALL))
        wide = settle(below.where(F.col("many") > SMALL))
    likely = (
        small.join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("node", "class", "n_shingles", "tokens", F.coalesce("root", "class").alias("root"))
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(lambda b: _likely(b, percent), "group binary, class binary")
    )
    groups = likely.unionByName(_blocks(wide, pairs=True)).distinct()
    roots = components(links.unionByName(_links(groups, sets, percent)))
    return _labelled(rows, classes, roots)


def _labelled(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    rooted = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "least_id", F.coalesce("root", "class").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    labels = settle(rooted.join(least, "root").select("class", "component"))
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (
        rows.join(labels, "class", "left")
        .select("doc_id", "text_key", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but those whose component has a lesser id, with all columns.

    Rows without an id can't be told apart by it and stay.
    """
    later = near_duplicates(docs, percent).where("not kept and doc_id is not null")
    gone = settle(later.select("doc_id", F.col("text_key").alias("row_key")).distinct())
    return join_whole(docs, gone, "left_anti", key=F.unhex(F.md5(text_or_empty())))
