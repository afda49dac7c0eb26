"""Quality rules judged by host: failure rates by domain, shrunk by an empirical beta prior.

Four rules of the document (symbol share, repeated lines, repeated 8-word runs, few words) may
fail, and each counts twice where it fails by twice its limit. Documents that fail any are
summed by host; a beta prior fitted to all hosts by moments shrinks each host's rate, so that
small hosts aren't judged by chance. How many failures a document may have depends on where its
host's posterior lies against the prior:

* strict hosts, surely above the prior's mean by a margin: none;
* clean hosts, surely below it by a margin: two;
* all others, whose documents are judged by the pooled prior: one.

The margin is half the prior's deviation, ``MARGIN`` at least; surely means a probability of 95 %
(``SURE`` deviations of the posterior). The base rules drop a document in any host. A document
that fails nothing always stays, whatever its host.

Counts are partial sums by host in every task, so a host with a third of all rows costs one row
a task; the verdicts come back by a join that adaptive execution may split.

Defined results: NULL text has no words and fails the base; NULL host is a host of its own;
repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .tasks import chunks

SYMBOLS = b"#*$%&|<>"
MARGIN = 0.02
SURE = 1.645
RUN = 8

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(texts: list[bytes | None]) -> np.ndarray:
    """The five counts of each text, one row a text."""
    found = [t.split() if t else [] for t in texts]
    rows = np.zeros((len(texts), 5), np.int64)
    for row, text, words in zip(rows, texts, found):
        if words:
            row[0] = len(words)
            row[1] = len(b"".join(words).decode("utf-8", "replace"))
            row[2] = len(text) - len(text.translate(None, SYMBOLS))
            lines = [line for line in text.split(b"\n") if line.strip()]
            row[3] = len(lines) - len(set(lines))
    for i in _maybe_repeating(found):
        rows[i, 4] = _repeated(found[i])
    return rows


def _maybe_repeating(found: list[list[bytes]]) -> list[int]:
    """Texts in which two runs of eight words have the same hash; all others repeat none."""
    lengths = np.array([len(words) for words in found])
    total = int(lengths.sum())
    if total < RUN:
        return []
    run = np.fromiter(map(hash, chain.from_iterable(found)), np.int64, total).view(np.uint64)
    of = np.repeat(np.arange(len(found)), lengths)
    width = 1
    while width < RUN:
        run = run[:-width] * np.uint64(0x9E3779B97F4A7C15) + (run[width:] ^ (run[width:] >> np.uint64(29)))
        width *= 2
    inside = of[: len(run)] == of[RUN - 1 :]
    run, of = run[inside], of[: len(run)][inside]
    keys = run + of.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    return np.unique(of[np.isin(keys, twice)]).tolist() if len(twice) else []


def _repeated(found: list[bytes]) -> int:
    """How many words lie in runs of eight words that the text has twice or more.

    Runs get exact numbers by doubling: the number of a run of 2n words is that of the pair
    of numbers of its halves.
    """
    n = len(found)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, n)
    width = 1
    while width < RUN:
        ids = np.unique(ids[:-width] * n + ids[width:], return_inverse=True)[1]
        width *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + RUN, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(chunk) for chunk in chunks(batch.column("text").to_pylist())]
        counts = np.concatenate(rows) if rows else np.zeros((0, 5), np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *map(pa.array, counts.T.copy())],
            names=["doc_id", "host", *(part.split()[0] for part in MEASURES.split(", "))],
        )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def failures() -> dict[str, Column]:
    """How often each rule fails for the document: 0, 1, or 2 beyond twice its limit."""

    def beyond(amount: Column, limit: Column) -> Column:
        return (amount > limit).cast("int") + (amount > 2 * limit).cast("int")

    words = F.col("n_words")
    return {
        "few_words": (words < 20).cast("int") + (words < 10).cast("int"),
        "many_symbols": beyond(100 * F.col("n_symbols"), 5 * F.col("word_chars")),
        "repeated_lines": beyond(10 * F.col("n_dup_lines"), words),
        "repeated_runs": beyond(100 * F.col("n_repeat_words"), 30 * words),
    }


def n_failures() -> Column:
    return sum(failures().values(), F.lit(0))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """host, n, failed, rate (shrunk), allowed: how many failures a document may have there."""
    fails = (n_failures() > 0).cast("long")
    hosts = settle(
        measured.groupBy("host").agg(F.count("*").alias("n"), F.sum(fails).alias("failed"))
    )
    alpha, beta = prior(hosts)
    strength = alpha + beta
    mean = alpha / strength
    margin = max(MARGIN, (mean * (1 - mean) / (strength + 1)) ** 0.5 / 2)
    rate = (F.col("failed") + alpha) / (F.col("n") + strength)
    sure = SURE * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + strength + 1))
    allowed = (
        F.when(F.col("rate") - sure > mean + margin, 0)
        .when(F.col("rate") + sure < mean - margin, 2)
        .otherwise(1)
    )
    return hosts.withColumn("rate", rate).withColumn("allowed", allowed)


def prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta(alpha, beta) by moments: the rates' mean, and their variance beyond chance."""
    rate = F.col("failed") / F.col("n")
    m = hosts.agg(
        F.avg(rate).alias("mean"),
        F.var_pop(rate).alias("spread"),
        F.avg(1 / F.col("n")).alias("chance"),
    ).first()
    mean = min(max(m["mean"] or 0.0, 1e-4), 1 - 1e-4)
    free = mean * (1 - mean)
    spread = max((m["spread"] or 0.0) - free * (m["chance"] or 0.0), 1e-6)
    strength = min(max(free / spread - 1, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the five counts, base_failed, n_failures, kept, the host's rate and allowed."""
    measured = settle(
        docs.select(
            "doc_id",
            F.col(host).cast("string").alias("host"),
            F.col("text").cast("binary").alias("text"),
        ).mapInArrow(_measured, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, host string, {MEASURES}")
    )
    verdicts = host_verdicts(measured)
    return (
        measured.join(
            verdicts.select(F.col("host").alias("of"), "rate", "allowed"),
            F.col("host").eqNullSafe(F.col("of")),
        )
        .withColumn("base_failed", base_failed())
        .withColumn("n_failures", n_failures())
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_failures") <= F.col("allowed")))
        .drop("of")
    )
