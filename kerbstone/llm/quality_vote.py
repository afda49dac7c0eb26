"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

* Terms of a text: its words and pairs of neighbouring words, each hashed to one of ``WORDS``
  numbers; runs of three character kinds (letters, upper case, digits, marks, ends of
  words and lines); and word events (a word that equals one of the eight before it, a line that
  was there before). Term frequencies are square-rooted, weighted by inverse document frequency
  (words and pairs by ``WORD_WEIGHT`` too) and set to unit length.
* Fit: at most ``SAMPLE`` labelled rows of each label (those with the least hash of the id, so
  reruns agree) give the term weights, a truncated singular value decomposition of ``RANK``
  dimensions, and the labelled vectors. That bound is the only sampling; it fixes the size of
  what is broadcast (2 * SAMPLE * RANK numbers and the projection).
* Vote: every document is projected, its cosines with all labelled vectors are computed in
  blocks by matrix products, and its ``NEIGHBOURS`` nearest vote with their similarity. Votes
  are weighted so that the balanced sample stands for the labels' true shares.

Defined results: NULL and empty texts have only the terms of an empty text and are voted on like
all others; NULL ids are never held out; repeated rows score alike; without labelled rows
of both kinds the score is the share of label 1 (0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .tasks import chunks

MODULUS = 4
SAMPLE = 2500
RANK = 48
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.7
BACK = 8
KINDS = 13
RUNS = KINDS**3
WORDS = 1024
WORD_WEIGHT = 0.5  # against the other terms; least loss in four folds of training rows of a small table
EVENTS = BACK + 3
TERMS = RUNS + 2 * WORDS + EVENTS  # in this order; words before pairs
SPARE = 16  # directions beyond RANK while the basis is sought
ROUNDS = 8
PRIME = 1_000_003
BLOCK = 512

# Character kinds of bytes: 0 blank, 1 line end, 2 vowel, 3 consonant, 4 other letter bytes,
# 5 upper case, 6 digit, 7 full stop, 8 comma, 9 other sentence marks, 10 symbols, 11 bars, 12 rest.
_KIND = np.full(256, 12, np.int64)
for _kind, _bytes in enumerate(
    (b" \t\r\v\f", b"\n", b"aeiou", b"bcdfghjklmnpqrstvwxyz", bytes(range(128, 256)),
     bytes(range(65, 91)), b"0123456789", b".", b",", b"!?;:'\"()-", b"#*$%&<>", b"|"),
):
    _KIND[list(_bytes)] = _kind


def term_counts(texts: list[bytes | None]) -> np.ndarray:
    """A row of term counts for each text."""
    framed = [b"\n" + (t or b"") + b"\n\n" for t in texts]
    lengths = np.array([len(t) for t in framed])
    kinds = _KIND[np.frombuffer(b"".join(framed), np.uint8)]
    runs = (kinds[:-2] * KINDS + kinds[1:-1]) * KINDS + kinds[2:]
    of = np.repeat(np.arange(len(texts)), lengths)
    same = of[:-2] == of[2:]
    counts = np.bincount(of[:-2][same] * TERMS + runs[same], minlength=len(texts) * TERMS)
    counts = counts.reshape(len(texts), TERMS).astype(np.float32)  # words and events come next
    found = [t.split() for t in framed]
    n = np.array([len(words) for words in found])
    words = np.fromiter(map(crc32, chain.from_iterable(found)), np.int64, int(n.sum()))
    text_of = np.repeat(np.arange(len(texts)), n)
    beside = text_of[1:] == text_of[:-1]
    pairs = ((words[:-1] * 31 + words[1:]) % PRIME % WORDS)[beside]
    for first, of_term, terms in ((RUNS, text_of, words % WORDS), (RUNS + WORDS, text_of[1:][beside], pairs)):
        number = np.bincount(of_term * WORDS + terms, minlength=len(texts) * WORDS)
        counts[:, first : first + WORDS] = number.reshape(len(texts), WORDS)
    for back in range(1, BACK + 1):
        again = (words[back:] == words[:-back]) & (text_of[back:] == text_of[:-back])
        counts[:, back - 1 - EVENTS] = np.bincount(text_of[back:][again], minlength=len(texts))
    for row, text, own in zip(counts, texts, found):
        lines = [line for line in text.split(b"\n") if line] if text else []
        row[-3] = 5 * (len(lines) - len(set(lines)))
        row[-2] = len(own) - len(set(own))
        row[-1] = len(own)
    return counts


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = counts.copy()
    for first, stop in ((0, RUNS), (RUNS, RUNS + WORDS), (RUNS + WORDS, TERMS - EVENTS)):
        some = rows[:, first:stop]
        some /= np.maximum(some.sum(1, keepdims=True), 1)
    events = rows[:, -EVENTS:]
    events /= np.maximum(events[:, -1:], 1)
    rows = np.sqrt(rows) * idf
    rows[:, RUNS : TERMS - EVENTS] *= WORD_WEIGHT
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _main_directions(rows: np.ndarray) -> np.ndarray:
    """The first RANK right singular vectors, by repeated products with the rows."""
    basis = np.random.default_rng(1).standard_normal((rows.shape[1], RANK + SPARE)).astype(np.float32)
    for _ in range(ROUNDS):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    turn = np.linalg.svd(rows @ basis, full_matrices=False)[2][:RANK]
    return np.ascontiguousarray(basis @ turn.T)


Model = dict[str, np.ndarray]  # plain arrays, so that executors need no class of ours


def learn(counts: np.ndarray, labels: np.ndarray, shares: tuple[float, float]) -> Model:
    """Term weights, projection and the labelled vectors with their votes."""
    seen = (counts > 0).sum(0)
    idf = (np.log((1 + len(counts)) / (1 + seen)) + 0.1).astype(np.float32)
    rows = _weighted(counts, idf)
    basis = _main_directions(rows)
    weight = np.array(shares, np.float32) / np.maximum(np.bincount(labels, minlength=2), 1)
    return {
        "idf": idf,
        "basis": basis,
        "vectors": np.ascontiguousarray(_unit(rows @ basis).T),
        "weight": weight[labels] / weight.max(),
        "good": labels == 1,
    }


def vote(model: Model, counts: np.ndarray) -> np.ndarray:
    """Each row's share of its neighbours' weighted votes that are for label 1."""
    near = _unit(_weighted(counts, model["idf"]) @ model["basis"]) @ model["vectors"]
    k = min(NEIGHBOURS, near.shape[1])
    best = np.argpartition(near, -k, axis=1)[:, -k:]
    close = np.maximum(np.take_along_axis(near, best, 1), 1e-6).astype(np.float64)
    votes = close**SHARPNESS * model["weight"][best]
    return (votes * model["good"][best]).sum(1) / votes.sum(1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        at = 0
        labels = batch.column("label")
        for texts in chunks(batch.column("text").to_pylist()):
            rows = [pack(r.tobytes()) for r in term_counts(texts)]  # mostly zeros
            yield pa.RecordBatch.from_arrays(
                [labels.slice(at, len(rows)), pa.array(rows, pa.binary())], names=["label", "counts"]
            )
            at += len(rows)


def fit(docs: DataFrame, labels: DataFrame, modulus: int = MODULUS) -> Model | float:
    """The model from the labelled rows that are not held out; the share of label 1 if too few."""
    usable = labels.where(~held_out(modulus) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    number = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    total = sum(number.values())
    share = number.get(1, 0) / total if total else 0.5
    if len(number) < 2:
        return share
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = usable.where("label = 0").orderBy(*order).limit(SAMPLE).unionByName(
        usable.where("label = 1").orderBy(*order).limit(SAMPLE)
    )
    found = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE rows
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .mapInArrow(_counted, "label int, counts binary")
        .toArrow()
    )
    values = found.column("label").to_numpy()
    if len(set(values.tolist())) < 2:
        return share
    rows = sorted(zip(values.tolist(), found.column("counts").to_pylist()))  # whatever came first
    unpack = zstandard.ZstdDecompressor().decompress
    counts = np.empty((len(rows), TERMS), np.float32)
    for row, (_, packed) in zip(counts, rows):
        row[:] = np.frombuffer(unpack(packed), np.float32)
    return learn(counts, np.array([label for label, _ in rows]), (1 - share, share))


def score(docs: DataFrame, labels: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of ``docs``."""
    model = fit(docs, labels, modulus)
    if isinstance(model, float):
        scored = docs.select("doc_id", F.lit(model).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                scores = [
                    vote(sent.value, term_counts(some[i : i + BLOCK]))
                    for some in chunks(texts)
                    for i in range(0, len(some), BLOCK)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                    names=["doc_id", "score"],
                )

        id_type = docs.schema["doc_id"].dataType.simpleString()
        scored = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
            run, f"doc_id {id_type}, score double"
        )
    return scored.select(
        "doc_id",
        held_out(modulus).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
