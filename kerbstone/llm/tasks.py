"""Small helpers for code that runs in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK = 1_000_000  # bytes of text that are worked on at once: arrays over them are up to 100 times as large


def chunks(texts: list[bytes | None], most: int = CHUNK) -> Iterator[list[bytes | None]]:
    """Runs of texts of a few MB together."""
    chunk: list[bytes | None] = []
    waiting = 0
    for text in texts:
        chunk.append(text)
        waiting += len(text or b"")
        if waiting > most:
            yield chunk
            chunk, waiting = [], 0
    if chunk:
        yield chunk


def text_chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[list[bytes | None]]:
    """As ``chunks``, from an Arrow column: only one run at a time is copied out of it."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        done = int(ends[start - 1]) if start else 0
        stop = int(np.searchsorted(ends, done + most, "right")) + 1
        yield texts.slice(start, stop - start).to_pylist()
        start = stop


class WordHashes(dict):
    """64-bit hashes of words, the same on every machine; a bounded memory of them."""

    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number

    def keep_bounded(self) -> None:
        if len(self) > self.MOST:
            self.clear()


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The groups of equal keys of batches that are sorted by ``key``, one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        changes = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
        bounds = [0, *(np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist(), len(keys)]
        for start, stop in zip(bounds, bounds[1:]):
            this = keys[start].as_py()
            if held and this != last:
                yield _joined(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = this
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
