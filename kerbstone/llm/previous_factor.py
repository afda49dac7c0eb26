"""Exact removal of repeated passages by longest-previous-factor arrays.

A byte goes if a ``LENGTH``-byte string covers it that also starts earlier (smaller doc_id, or
same document, earlier start). Every window of that length has an anchor, its least 32-byte
piece by hash, so equal windows have equal anchors at the same place, and the windows of one
anchor occurrence form one context of at most 168 bytes. Contexts are dealt out by anchor:

1. Anchors that occur once are dropped. Where a context is equal to an earlier one (two
   independent 64-bit hashes), all its windows are later copies: no text has to move.
2. What is left are different contexts of one anchor, mostly where a copied passage begins or
   ends. Their bytes are gathered by anchor, and for about a MB of them at a time a suffix
   array is built, up to the length that matters. In suffix order the previous and the next
   smaller position of a suffix give its longest previous factor; one of ``LENGTH`` marks
   the window.
3. Anchors with very many different contexts are not gathered: their windows are dealt out by
   the windows' own hashes, and the first rule decides them.

Streams of sorted rows are read with constant memory, so a passage in a third of all documents
needs no large group in memory. Spans are merged by document and cut out.

Defined results: NULL text is empty and loses nothing; NULL ids come last; rows that repeat
doc_id and text are one document, get the same result each and are no copies of each other;
rows of one doc_id with different texts are ordered by a hash of the text; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_rows, join_whole, settle, unused, with_row_key
from .tasks import text_chunks, whole_groups

LENGTH = 100
PIECE = 32
MANY = 2048  # contexts of one anchor beyond which windows are dealt out singly
GATHER = 1_000_000  # bytes of contexts in one suffix array

_RANDOM = np.random.default_rng(9).integers(0, 2**63, 258, dtype=np.int64).astype(np.uint64)
_BYTE = _RANDOM[:256]
_BASE, _ODD = (_RANDOM[256:] << np.uint64(3)) | np.uint64(5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The powers 0, 1, ... n - 1, modulo 2^64."""
    power = np.full(n, base)
    power[0] = 1
    return np.multiply.accumulate(power, out=power)


# --- anchors ------------------------------------------------------------------------------


def anchors(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Contexts of the texts: number of the text, anchor and context hash, start, span.

    A context holds the windows that start at start, start + 1, ... start + span.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return dict.fromkeys(("doc", "anchor", "context", "start", "span"), empty)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=total[1:])
    # A string's sum holds the powers of its places. Times the inverse power of its start it
    # is the same wherever the string stands, in whichever chunk or task.
    back = _powers(_INVERSE, n)

    def hashed(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (total[stop] - total[start]) * back[start]

    piece = _mix((total[PIECE:] - total[:-PIECE]) * back[: n - PIECE + 1])
    # The least piece of each window: hash above, place below, so that the leftmost wins.
    least = (piece & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(piece), dtype=np.uint64)
    width, pieces = 1, LENGTH - PIECE + 1
    while 2 * width <= pieces:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: n - LENGTH + 1], least[pieces - width : pieces - width + n - LENGTH + 1])
    inside = np.zeros(n + 1, np.int8)
    long_enough = lengths >= LENGTH
    np.add.at(inside, begin[long_enough], 1)
    np.add.at(inside, (begin + lengths)[long_enough] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(inside, dtype=np.int8))
    if not len(window):
        return dict.fromkeys(("doc", "anchor", "context", "start", "span"), empty)
    place = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [len(window)])) - 1
    start, span, at = window[first], window[last] - window[first], place[first]
    shape = ((at - start) * 256 + span).astype(np.uint64)
    context = _mix(hashed(start, start + span + LENGTH) + _mix(shape + np.uint64(1)))
    doc = np.searchsorted(begin, start, "right") - 1
    return {
        "doc": doc,
        "anchor": piece[at].view(np.int64),
        "context": context.view(np.int64),
        "start": start - begin[doc],
        "span": span,
    }


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row = 0
        for texts in text_chunks(batch.column("text")):
            found = anchors([t or b"" for t in texts])
            doc = pa.array(found["doc"] + row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found["anchor"]),
                    pa.array(found["context"]),
                    batch.column("doc_id").take(doc),
                    batch.column("row_key").take(doc),
                    pa.array(found["start"].astype(np.int32)),
                    pa.array(found["span"].astype(np.int32)),
                ],
                names=["anchor", "context", "doc_id", "row_key", "start", "span"],
            )
            row += len(texts)


# --- equal contexts -----------------------------------------------------------------------


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, context and text order to those that matter, with ``later``.

    later: the context is equal to an earlier one. Not later: the first of its context, where
    the anchor has other contexts too. Two rows are carried from batch to batch: the first of
    the anchor that is being read, and the first of its context.
    """
    held: pa.RecordBatch | None = None
    told = False  # whether the first row of the anchor at the end has been given out
    for batch in batches:
        if not batch.num_rows:
            continue
        carried = held.num_rows if held is not None else 0
        if carried:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = batch.num_rows
        anchor = batch.column("anchor").to_numpy()
        context = batch.column("context").to_numpy()
        key, start = batch.column("row_key").to_numpy(), batch.column("start").to_numpy()
        ids = batch.column("doc_id").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new_context = new_anchor | np.concatenate(([True], context[1:] != context[:-1]))
        row = np.arange(n)
        of_anchor = np.maximum.accumulate(np.where(new_anchor, row, 0))
        of_context = np.maximum.accumulate(np.where(new_context, row, 0))
        twin = (ids == ids[of_context]) & (key == key[of_context]) & (start == start[of_context])
        later = ~new_context & ~twin
        other = new_context & ~new_anchor
        fresh = row >= carried
        first = np.zeros(n, bool)
        first[of_anchor[other & fresh]] = True
        if carried and told:
            first[0] = False
        out = (later & fresh) | (other & fresh) | first
        end = of_anchor[-1]
        told = bool(first[end]) or (told and bool(carried) and end == 0)
        held = batch.take(pa.array(np.unique([end, of_context[-1]])))
        kept = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays(
            [*batch.take(pa.array(kept)).columns, pa.array(later[kept])],
            names=[*batch.schema.names, "later"],
        )


ROW = "row_key long, start int, span int"


def _repeated(rows: DataFrame, id_type: str) -> DataFrame:
    return (
        rows.repartition("anchor")
        .sortWithinPartitions(
            "anchor", "context", F.asc_nulls_last("doc_id"), "row_key", "start"
        )
        .mapInArrow(
            _repeats, f"anchor long, context long, doc_id {id_type}, {ROW}, later boolean"
        )
    )


# --- unequal contexts ----------------------------------------------------------------------


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, packed: texts compressed for the way through a shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = chain.from_iterable(text_chunks(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([press(t or b"") for t in texts], pa.binary())],
                names=["doc_id", "row_key", "packed"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row_key", F.col("text").cast("binary").alias("text")).mapInArrow(
        pack, f"doc_id {id_type}, row_key long, packed binary"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with places to their contexts; windows of crowded anchors one by one."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows: list[tuple] = []
        places = batch.column("places").to_pylist()
        for i, (text, own) in enumerate(zip(batch.column("packed").to_pylist(), places)):
            text = unpack(text)
            for p in own:
                start, stop = p["start"], p["start"] + p["span"]
                if not p["crowded"]:
                    rows.append((i, p["anchor"], 0, start, p["span"], text[start : stop + LENGTH]))
                    continue
                for at in range(start, stop + 1):
                    window = text[at : at + LENGTH]
                    rows.append((i, xxhash.xxh64_intdigest(window), xxhash.xxh3_64_intdigest(window), at, 0, None))
        doc, anchor, context, start, span, cut = zip(*rows) if rows else ((),) * 6
        index = pa.array(doc, pa.int32())
        signed = lambda x: pa.array(np.array([v & (2**64 - 1) for v in x], np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                signed(anchor), signed(context), batch.column("doc_id").take(index),
                batch.column("row_key").take(index), pa.array(start, pa.int32()),
                pa.array(span, pa.int32()), pa.array(cut, pa.binary()),
            ],
            names=["anchor", "context", "doc_id", "row_key", "start", "span", "cut"],
        )


def suffix_ranks(data: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The ranks of all suffixes of ``data`` by their first 1, 2, 4 ... LENGTH bytes.

    Ranks of up to twice the width come from pairs of ranks; the last step overlaps. Past the
    end stands 0.
    """
    n = len(data)
    levels = [(1, data.astype(np.int64) + 1)]
    while levels[-1][0] < LENGTH:
        width, rank = levels[-1]
        step = min(width, LENGTH - width)
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:]
        levels.append((width + step, np.unique(rank * (max(n, 256) + 2) + after, return_inverse=True)[1] + 1))
    return levels


def common_prefix(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at ``a`` and ``b`` have in common, LENGTH at most."""
    n = len(levels[0][1])
    width, rank = levels[-1]
    whole = rank[a] == rank[b]
    a, b, common = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for width, rank in reversed(levels[:-1]):
        inside = ~whole & (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        common[same] += width
        a[same] += width
        b[same] += width
    return np.where(whole, LENGTH, np.minimum(common, LENGTH))


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the last place before it with a smaller value, or -1.

    All places between a place and its candidate hold larger values, so where the candidate's
    is larger, too, the candidate's own candidate is next. Chains halve with every round.
    """
    candidate = np.arange(len(values)) - 1
    wrong = np.arange(1, len(values))
    while len(wrong):
        at = candidate[wrong]
        wrong = wrong[(at >= 0) & (values[at] > values[wrong])]
        candidate[wrong] = candidate[candidate[wrong]]
    return candidate


def previous_factors(contexts: list[bytes], spans: np.ndarray) -> list[np.ndarray]:
    """For each context, in text order, the longest previous factor (LENGTH at most) of its windows.

    The longest string at a window's start that also starts at an earlier window: in suffix
    order, the window before it with a smaller place, or the one after, has it in common.
    """
    lengths = np.array([len(c) for c in contexts])
    begin = np.cumsum(lengths) - lengths
    levels = suffix_ranks(np.frombuffer(b"".join(contexts), np.uint8))
    counts = spans + 1
    edges = np.cumsum(counts)
    windows = np.arange(edges[-1]) - np.repeat(edges - counts, counts) + np.repeat(begin, counts)
    place = np.argsort(levels[-1][1][windows], kind="stable")  # the suffix array, equal ones in text order
    n = len(place)
    factor = np.zeros(n, np.int64)
    before, after = previous_smaller(place), n - 1 - previous_smaller(place[::-1])[::-1]
    for neighbour, there in ((before, before >= 0), (after, after < n)):
        own, other = windows[place[there]], windows[place[neighbour[there]]]
        factor[place[there]] = np.maximum(factor[place[there]], common_prefix(levels, own, other))
    return np.split(factor, edges[:-1])


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor and text order to the runs of windows that go."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for group in whole_groups(batches, "anchor"):
        waiting.append(group)
        size += group.column("cut").nbytes
        if size > GATHER:
            yield _runs(waiting)
            waiting, size = [], 0
    if waiting:
        yield _runs(waiting)


def _runs(groups: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(groups).combine_chunks().to_batches()[0]
    start = rows.column("start").to_numpy()
    found = previous_factors(rows.column("cut").to_pylist(), rows.column("span").to_numpy().astype(np.int64))
    index, first, span = [], [], []
    for i, factor in enumerate(found):
        marks = factor >= LENGTH
        if marks.any():
            edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
            index += [i] * (len(edges) // 2)
            first += (start[i] + edges[::2]).tolist()
            span += (edges[1::2] - edges[::2] - 1).tolist()
    at = pa.array(index, pa.int32())
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id").take(at), rows.column("row_key").take(at), pa.array(first, pa.int32()), pa.array(span, pa.int32())],
        names=["doc_id", "row_key", "start", "span"],
    )


# --- the operator ---------------------------------------------------------------------------


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, spans (array of start, span): runs of windows that also start earlier."""
    docs = with_row_key(docs.select("doc_id", "text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    occurrences = docs.select(
        "doc_id", "row_key", F.col("text").cast("binary").alias("text")
    ).mapInArrow(_occurrences, f"anchor long, context long, doc_id {id_type}, {ROW}")
    repeats = settle(_repeated(occurrences, id_type))
    unequal = repeats.where("not later")
    crowded = unequal.groupBy("anchor").agg((F.count("*") > MANY).alias("crowded"))
    places = (
        unequal.join(crowded, "anchor")
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set(F.struct("anchor", "start", "span", "crowded")).alias("places"))
    )
    cuts = settle(
        join_rows(packed(docs), settle(places), "inner")
        .select("doc_id", "row_key", "packed", "places")
        .dropDuplicates(["doc_id", "row_key"])
        .mapInArrow(_cut, f"anchor long, context long, doc_id {id_type}, {ROW}, cut binary")
    )
    gathered = (
        cuts.where("cut is not null")
        .repartition("anchor")
        .sortWithinPartitions("anchor", F.asc_nulls_last("doc_id"), "row_key", "start")
        .mapInArrow(_factors, f"doc_id {id_type}, {ROW}")
    )
    single = _repeated(cuts.where("cut is null").drop("cut"), id_type).where("later")
    columns = ("doc_id", "row_key", "start", "span")
    every = repeats.where("later").select(*columns).unionByName(gathered).unionByName(single.select(*columns))
    return settle(
        every.groupBy("doc_id", "row_key").agg(
            F.collect_list(F.struct("start", "span")).alias("spans")
        )
    )


def _keep(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What stays of a text, and how many runs go."""
    if not spans:
        return text, 0
    kept, runs, end = [], 0, -1
    for start, stop in sorted((s["start"], s["start"] + s["span"] + LENGTH) for s in spans):
        if start > end:
            kept.append(text[max(end, 0) : start])
            runs += 1
        end = max(end, stop)
    kept.append(text[end:])
    return b"".join(kept), runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_bytes, n_removed, n_spans, kept (binary): a row for each of ``docs``."""
    keyed = with_row_key(docs.select("doc_id", "text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            spans = batch.column("spans").to_pylist()
            for text, own in zip(batch.column("packed").to_pylist(), spans):
                text = unpack(text)
                rest, n = _keep(text, own)
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                runs.append(n)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "row_key", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return (
        join_rows(packed(keyed), repeated_spans(docs))
        .select("doc_id", "row_key", "packed", "spans")
        .mapInArrow(
            cut_out,
            f"doc_id {id_type}, row_key long, n_bytes long, n_removed long, n_spans long, kept binary",
        )
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of their texts, and n_chars where they have it.

    A character that loses one of its bytes goes. Rows of which no word is left go, too, if
    something was removed from them.
    """
    (kept,) = unused(docs, "kept_bytes")
    rest = remove_repeats(docs).where("n_removed > 0").dropDuplicates(["doc_id", "row_key"])
    joined = join_whole(docs, settle(rest.select("doc_id", "row_key", "kept")), "left", kept=kept)
    # Bytes that are no longer UTF-8 become a mark, and the mark goes.
    clean = F.replace(F.make_valid_utf8(F.col(kept).cast("string")), F.lit("\ufffd"), F.lit(""))
    changed = F.col(kept).isNotNull()
    new = {"text": F.when(changed, clean).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars")
        )
    return joined.where(~changed | clean.rlike(r"[^\x20\x09-\x0D]")).withColumns(new).drop(kept)
