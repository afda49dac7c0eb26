"""LM scoring by a log-bilinear model, trained with noise-contrastive estimation.

Outcomes of the model are the distinct training tokens and one for all others, as for the add-one
base. The ``WORDS`` most frequent tokens are classes of their own; every other token belongs to
one of ``BUCKETS`` classes by the hash of its text. Classes stand in groups: ``GROUP`` words of
neighbouring frequency to each, and all buckets in the last.

The ``POSITIONS`` tokens before a token give a context h: the sum of their classes' vectors, each
position's weighed by weights of its own; a text starts after ends. A token has the probability
P(group | h) P(class | group, h), both softmax functions of products with h. A token of a bucket
has its share of the bucket besides, by absolute discounting; what is discounted goes to unknown
tokens, which are one outcome however they hash.

* Counts: Spark counts every training token. Biases begin at, and noise comes from, these counts.
* Training: every task goes over its training texts once, in batches of ``BATCH`` tokens, and tells
  them from ``NOISE`` classes and groups drawn anew for each batch (steps by Adagrad, which move only
  the rows a batch concerns). How a token is learned does not depend on how many there are. The mean
  of all tasks' parameters, weighted by tokens, is the model: it is summed up by Spark, part by part,
  in streams of constant memory.
* Scoring: products of a block of contexts with the groups, and of each group's contexts with its
  classes, give all scores that the normalised log-probabilities need.

The model's size does not grow with the input; what it learns from does: all training tokens.
As in any training by parts, scores depend on how rows are dealt to tasks.

Tokens of more than ``LONGEST`` bytes stand as their SHA-256 behind a blank, which no token holds,
so a token takes few bytes wherever it is kept, however long it is and often it occurs. The most
frequent tokens, at most ``COMMON``, go to all tasks with their counts (a few MB whatever the
input); the others are looked up by a join. They are rare, so no key of that join is hot among
training texts, and adaptive execution splits what else is.

Defined results: NULL text is empty and has the end token only; repeated rows are scored each;
NULL ids are never held out; an empty table gives an empty result; without training rows every
token is unknown, and both scores are 0.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, settle
from .tasks import text_chunks

END = b"\n"  # no word can hold it
WORDS = 4032
GROUP = 64
BUCKETS = 128
POSITIONS = 3
VECTOR = 16
NOISE = 16
BATCH = 1024
RATE = 0.1
PART = 256  # rows of a parameter that are summed up together
SPREAD = 16  # tasks that sum up a part first
COMMON = 100_000
BANDS = 16  # of frequency, to each doubling
LONGEST = 64
MODULUS = 7
CHUNK = 1_000_000  # bytes of text; their tokens are Python objects, some ten times as large
BLOCK = 32_768  # tokens scored at once
SMALL = 2048  # of which so many are held against all groups at once
FLUSH = 200_000  # distinct words a task holds before it gives out its counts
NEVER = -1e4  # score of a bucket that no training token is in

Model = dict[str, np.ndarray]  # plain arrays, so that executors need no class of ours


def _tokens(texts: list[bytes | None]) -> list[list[bytes]]:
    found = [[*t.lower().split(), END] if t else [END] for t in texts]
    for words in found:
        if len(max(words, key=len)) > LONGEST:
            words[:] = [w if len(w) <= LONGEST else b" " + hashlib.sha256(w).digest() for w in words]
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def given() -> pa.RecordBatch:
        columns = pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())
        return pa.RecordBatch.from_arrays(list(columns), names=["token", "n"])

    for batch in batches:
        for texts in text_chunks(batch.column("text"), CHUNK):
            counts.update(chain.from_iterable(_tokens(texts)))
            if len(counts) > FLUSH:
                yield given()
                counts.clear()
    yield given()


def bucket(token: bytes) -> int:
    return crc32(token) % BUCKETS


def class_ids(flat: list[bytes], classes: dict[bytes, int], words: int) -> np.ndarray:
    """Classes of tokens; ``classes`` may leave out tokens of buckets, which follow the ``words``."""
    ids = np.fromiter(map(classes.get, flat, repeat(-1)), np.int64, len(flat))
    others = np.flatnonzero(ids < 0)
    ids[others] = [words + crc32(flat[i]) % BUCKETS for i in others.tolist()]
    return ids.astype(np.int16)  # short numbers sort by radix


def contexts(ids: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """Classes of the ``POSITIONS`` tokens before each token, the nearest first."""
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    found = np.full((len(ids), POSITIONS), end, ids.dtype)
    for j in range(POSITIONS):
        found[j + 1 :, j] = np.where(place[j + 1 :] > j, ids[: -j - 1], end)
    return found


def initial(counts: np.ndarray, seed: int = 2) -> Model:
    """A model that knows only how frequent the classes are; the last ``BUCKETS`` are buckets."""
    size = len(counts)
    words = size - BUCKETS
    random = np.random.default_rng(seed)
    group = np.arange(size) // GROUP
    group[words:] = -(-words // GROUP)
    share = np.maximum(counts, 1 / BUCKETS)  # empty buckets together are like one token
    share /= share.sum()
    group_share = np.bincount(group, share)

    def outcomes(shares: np.ndarray, spread: float) -> np.ndarray:
        vectors = random.normal(0, spread, (len(shares), VECTOR))
        return np.column_stack([vectors, np.log(shares)]).astype(np.float32)

    return {
        "group": group,
        "share": share,
        "group_share": group_share,
        "before": random.normal(0, 0.1, (size, VECTOR)).astype(np.float32),
        "position": np.full((POSITIONS, VECTOR), 1 / POSITIONS, np.float32),
        "word": outcomes(share, 0.1),  # the last column is the bias
        "groups": outcomes(group_share, 0.0),
    }


LEARNED = ("before", "position", "word", "groups")


def _hidden(model: Model, context: np.ndarray) -> np.ndarray:
    """h of each context, and a 1 for the bias."""
    h = np.ones((len(context), VECTOR + 1), np.float32)
    h[:, :VECTOR] = 0
    for j, weights in enumerate(model["position"]):
        h[:, :VECTOR] += model["before"].take(context[:, j], 0) * weights
    return h


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Trainer:
    """Steps of noise-contrastive estimation on one task's copy of the model."""

    def __init__(self, model: Model, seed: int) -> None:
        self.model = {k: v.copy() if k in LEARNED else v for k, v in model.items()}
        self.squares = {k: np.full_like(model[k], 1e-6) for k in LEARNED}
        self.random = np.random.default_rng(seed)
        self.reach = np.cumsum(model["share"])
        self.expected = np.log(NOISE * model["share"]).astype(np.float32)
        self.expected_group = np.log(NOISE * model["group_share"]).astype(np.float32)
        self.group_chances = model["group_share"] / model["group_share"].sum()

    def go_over(self, ids: np.ndarray, context: np.ndarray) -> None:
        order = self.random.permutation(len(ids))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            self.step(ids[some], context[some])

    def step(self, ids: np.ndarray, context: np.ndarray) -> None:
        position = self.model["position"]
        near = self.model["before"].take(context.T, 0)  # position, token, component
        h = np.ones((len(ids), VECTOR + 1), np.float32)
        h[:, :VECTOR] = np.einsum("jik,jk->ik", near, position)
        slope = (self._words(h, ids) + self._groups(h, self.model["group"][ids]))[:, :VECTOR]
        of_weights = np.einsum("ik,jik->jk", slope, near)
        self._move_rows("before", context.T.ravel(), (slope * position[:, None]).reshape(-1, VECTOR))
        self._move("position", slice(None), of_weights)

    def _words(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Moves the classes' rows; gives the loss's slope by the contexts."""
        rows = self.model["word"]
        drawn = np.searchsorted(self.reach, self.random.random(NOISE) * self.reach[-1])
        noise = np.minimum(drawn, len(rows) - 1).astype(ids.dtype)
        own, other = rows.take(ids, 0), rows.take(noise, 0)
        miss = _sigmoid(np.einsum("ij,ij->i", h, own) - self.expected.take(ids))[:, None] - 1
        hit = _sigmoid(h @ other.T - self.expected.take(noise))
        self._move_rows("word", np.concatenate([ids, noise]), np.concatenate([miss * h, hit.T @ h]))
        return miss * own + hit @ other

    def _groups(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The same for groups: they are few, so noise is a number of draws for each."""
        rows, shares = self.model["groups"], self.group_chances
        times = self.random.multinomial(NOISE, shares)
        noise = np.flatnonzero(times)
        own, other = rows.take(ids, 0), rows.take(noise, 0)
        miss = _sigmoid(np.einsum("ij,ij->i", h, own) - self.expected_group.take(ids))[:, None] - 1
        hit = _sigmoid(h @ other.T - self.expected_group.take(noise)) * times[noise].astype(np.float32)
        self._move_rows("groups", np.concatenate([ids, noise]).astype(np.int16), np.concatenate([miss * h, hit.T @ h]))
        return miss * own + hit @ other

    def _move_rows(self, name: str, ids: np.ndarray, slopes: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        found = ids.take(order)
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        self._move(name, found.take(first), np.add.reduceat(slopes.take(order, 0), first))

    def _move(self, name: str, rows: np.ndarray | slice, slope: np.ndarray) -> None:
        squares = self.squares[name][rows] + slope * slope
        self.squares[name][rows] = squares
        self.model[name][rows] -= RATE * slope / np.sqrt(squares)


def _trained(model: Model, classes: dict[bytes, int], words: int):
    """Rows (name, part, spread, weight, rows): a task's parameters times its training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        trainer = Trainer(model, task)
        end = classes.get(END, 0)
        n = 0
        for batch in batches:
            for texts in text_chunks(batch.column("text"), CHUNK):
                tokens = _tokens(texts)
                lengths = np.array([len(t) for t in tokens])
                ids = class_ids(list(chain.from_iterable(tokens)), classes, words)
                trainer.go_over(ids, contexts(ids, np.cumsum(lengths) - lengths, end))
                n += len(ids)
        if n:
            for name in LEARNED:
                rows = trainer.model[name].astype(np.float64) * n
                for at in range(0, len(rows), PART):
                    yield _part(name, at, task % SPREAD, float(n), rows[at : at + PART])

    return run


PARTS = "name string, at int, spread int, weight double, rows binary"


def _part(name: str, at: int, spread: int, weight: float, rows: np.ndarray) -> pa.RecordBatch:
    columns = [[name], [at], [spread], [weight], [rows.tobytes()]]
    types = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        list(map(pa.array, columns, types)), names=["name", "at", "spread", "weight", "rows"]
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each part: a stream of constant memory."""
    sums: dict[tuple[str, int, int], tuple[float, np.ndarray]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            key, rows = (r["name"], r["at"], r["spread"]), np.frombuffer(r["rows"])
            weight, total = sums.get(key, (0.0, 0.0))
            sums[key] = weight + r["weight"], total + rows
    for (name, at, spread), (weight, rows) in sums.items():
        yield _part(name, at, spread, weight, rows)


def train(training: DataFrame, model: Model, classes: dict[bytes, int], words: int) -> Model:
    """The mean of what all tasks learn from their rows' column ``text``."""
    parts = training.mapInArrow(_trained(model, classes, words), PARTS)
    once = parts.repartition("name", "at", "spread").mapInArrow(_summed, PARTS)
    whole = once.withColumn("spread", F.lit(0)).repartition("name", "at").mapInArrow(_summed, PARTS)
    learned = {k: v.copy() if k in LEARNED else v for k, v in model.items()}
    for r in whole.toArrow().to_pylist():  # the model's size, whatever the input
        rows = learned[r["name"]][r["at"] : r["at"] + PART]
        rows[:] = (np.frombuffer(r["rows"]) / r["weight"]).reshape(rows.shape)
    return learned


def log_probabilities(model: Model, ids: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(group | context) and log10 P(class | group, context) of each token."""
    of_group, of_class = np.empty(len(ids)), np.empty(len(ids))
    bounds = np.flatnonzero(np.diff(model["group"], prepend=-1, append=len(model["group"])))
    for at in range(0, len(ids), BLOCK):
        some = slice(at, at + BLOCK)
        own = ids[some]
        group = model["group"].take(own)
        h = _hidden(model, context[some])
        of_group[some] = np.concatenate(
            [_picked(h[i : i + SMALL] @ model["groups"].T, group[i : i + SMALL]) for i in range(0, len(own), SMALL)]
        )
        order = np.argsort(group.astype(np.int16), kind="stable")  # short numbers sort by radix
        h, group, own = h.take(order, 0), group.take(order), own.take(order)
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=len(bounds))).tolist()
        within = np.empty(len(own))
        for start, stop in zip(edges, edges[1:]):
            first, last = bounds[group[start]], bounds[group[start] + 1]
            within[start:stop] = _picked(h[start:stop] @ model["word"][first:last].T, own[start:stop] - first)
        of_class[at + order] = within
    return of_group, of_class


def _picked(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 of the softmax of each row, at its place: the others are held against that score."""
    scores -= scores[np.arange(len(at)), at][:, None]
    top = 0.0
    if scores.max() > 80:  # beyond it single precision may overflow
        top = scores.max(1)
        scores -= top[:, None]
    return -(np.log(np.exp(scores, out=scores).sum(1), dtype=np.float64) + top) / np.log(10)


def _scored(model: Model, words: int, common: dict[bytes, tuple[int, int]], base: float, share):
    """Rows (row, doc_id, token, n, known, base, model): a text's sums, then its rare tokens as keys.

    A text's own row has the groups' log-probabilities of rare tokens; their own rows have the
    classes', which count only if the token is known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(common)}
        rare = len(number)
        values = np.array(
            [*((np.log10(n + 1) - base, share(n, c) if c >= words else 0.0) for n, c in common.values()), (0.0, 0.0)]
        )
        class_of = np.array([*(c for _, c in common.values()), -1], np.int16)
        end = int(class_of[number.get(END, rare)])
        for batch in batches:
            at = 0
            keys_of = batch.select(["row", "doc_id"])  # a rare token repeats its row's keys, not its text
            for texts in text_chunks(batch.column("text"), CHUNK):
                tokens = _tokens(texts)
                lengths = np.array([len(t) for t in tokens])
                starts = np.cumsum(lengths) - lengths
                flat = list(chain.from_iterable(tokens))
                numbers = np.fromiter(map(number.get, flat, repeat(rare)), np.int64, len(flat))
                places = np.flatnonzero(numbers == rare)
                rare_flat = list(map(flat.__getitem__, places.tolist()))
                ids = class_of[numbers]
                ids[places] = [words + crc32(t) % BUCKETS for t in rare_flat]
                of_group, of_class = log_probabilities(model, ids, contexts(ids, starts, max(end, 0)))
                text_of = np.repeat(np.arange(len(texts)), lengths)
                found = (
                    pa.table([text_of[places], pa.array(rare_flat, pa.binary()), of_class[places]], ["text", "token", "model"])
                    .group_by(["text", "token"], use_threads=False)
                    .aggregate([("model", "count"), ("model", "sum")])
                )
                of_class[places] = 0.0
                row = keys_of.slice(at, len(texts))
                sums = [np.add.reduceat(x, starts) for x in (
                    np.ones(len(flat)), numbers != rare, values[numbers, 0], of_group + of_class + values[numbers, 1])]
                text, token, times, within = (
                    found.column(c).combine_chunks() for c in ("text", "token", "model_count", "model_sum")
                )
                none = np.zeros(len(found))
                for of, keys, n, known, b, m in (
                    (row, pa.nulls(len(texts), pa.binary()), sums[0], sums[1], sums[2], sums[3]),
                    (row.take(text), token, times.to_numpy(), none, none, within.to_numpy()),
                ):
                    yield pa.RecordBatch.from_arrays(
                        [
                            of.column("row"), of.column("doc_id"), keys,
                            pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(b), pa.array(m),
                        ],
                        names=["row", "doc_id", "token", "n", "known", "base", "model"],
                    )
                at += len(texts)

    return run


def _frequent(counts: DataFrame) -> tuple[list[bytes], dict[bytes, int]]:
    """The tokens that are classes, the most frequent first, and those all tasks know, with counts.

    Tokens are taken by bands of frequency, counted beforehand, so that the driver is sent the
    tokens it keeps and not the most frequent ones of every task.
    """
    banded = counts.withColumn("band", F.floor(F.log2("n") * BANDS).cast("int"))
    sizes = banded.groupBy("band").count().collect()  # 63 * BANDS + 1 rows at most
    within, enough, fitting = 0, None, None
    for band, count in sorted(sizes, reverse=True):
        if within < WORDS:
            enough = band
        within += count
        if within <= COMMON:
            fitting = band
    first = (
        banded.where(F.col("band") >= F.lit(enough))
        .orderBy(F.desc("n"), "token")
        .limit(WORDS)
        .collect()
    )
    known = F.coalesce(F.col("band") >= F.lit(fitting), F.lit(False)) | (F.col("token") == F.lit(END))
    common = {bytes(r["token"]): r["n"] for r in [*first, *banded.where(known).collect()]}
    chosen = [bytes(r["token"]) for r in first]
    if END in common and END not in chosen:
        chosen[-1] = END
    return chosen, common


def score(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text")
    )
    training = texts.where(~held_out(modulus)).select("text")
    counts = settle(
        training.mapInArrow(_counted, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    )
    every = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    n_tokens, n_distinct = every["tokens"] or 0, every["distinct"]
    chosen, frequent = _frequent(counts)
    words = len(chosen)
    classes = {w: i for i, w in enumerate(chosen)}
    common = {w: (n, classes[w] if w in classes else words + bucket(w)) for w, n in frequent.items()}
    in_buckets = (
        counts.join(
            F.broadcast(docs.sparkSession.createDataFrame([(bytearray(w),) for w in chosen], "token binary")),
            "token",
            "left_anti",
        )
        .groupBy((F.crc32("token") % BUCKETS).cast("int").alias("bucket"))
        .agg(
            F.sum("n").alias("tokens"),
            F.count("*").alias("distinct"),
            F.count(F.when(F.col("n") == 1, 1)).alias("once"),
            F.count(F.when(F.col("n") == 2, 1)).alias("twice"),
        )
        .collect()
    )
    rest, types, once, twice = (sum(r[k] for r in in_buckets) for k in ("tokens", "distinct", "once", "twice"))
    discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    free = discount * types / rest if rest else 1.0  # the part of all buckets that unknown tokens have
    left = [1.0] * BUCKETS
    sizes = np.array([*(frequent[w] for w in chosen), *[0] * BUCKETS], np.float64)
    for r in in_buckets:
        left[r["bucket"]] = (r["tokens"] - discount * r["distinct"]) / (1 - free)
        sizes[words + r["bucket"]] = r["tokens"]
    model = train(training, initial(sizes), {w: c for w, (_, c) in common.items()}, words)
    model["word"][words:][sizes[words:] == 0] = [*[0] * VECTOR, NEVER]
    base = float(np.log10(n_tokens + n_distinct + 1))

    def share(n: int, of: int) -> float:
        return float(np.log10((n - discount) / left[of - words]))

    rows = texts.mapInArrow(
        _scored(model, words, common, base, share),
        f"row long, doc_id {id_type}, token binary, n long, known long, base double, model double",
    )
    # A text's own row has no token; a key that no token has keeps these rows spread out.
    key = F.coalesce("token", F.concat(F.lit(b" "), F.col("row").cast("string").cast("binary")))
    size_of = F.element_at(F.lit(left), (F.crc32("token") % BUCKETS).cast("int") + 1)
    rare = counts.select(
        F.col("token").alias("key"), F.col("n").alias("times"), F.log10((F.col("n") - discount) / size_of).alias("share")
    )
    seen = F.col("times").isNotNull()
    is_token = F.col("token").isNotNull()
    scored = (
        rows.withColumn("key", key)
        .join(rare, "key", "left")
        .groupBy("row", "doc_id")
        .agg(
            F.sum(F.when(~is_token, F.col("n")).otherwise(0)).alias("n_tokens"),
            F.sum(F.col("known") + F.when(is_token & seen, F.col("n")).otherwise(0)).alias("n_known"),
            F.sum(
                F.col("base")
                + F.when(is_token, F.col("n") * (F.log10(F.coalesce("times", F.lit(0)) + 1) - base)).otherwise(0.0)
            ).alias("base_score"),
            F.sum(
                F.when(~is_token, F.col("model"))
                .when(seen, F.col("model") + F.col("n") * F.col("share"))
                .otherwise(F.col("n") * float(np.log10(free)))
            ).alias("score"),
        )
    )
    return scored.select(
        "doc_id",
        held_out(modulus).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
