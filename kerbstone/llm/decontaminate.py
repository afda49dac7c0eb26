"""Benchmark decontamination by a prefix-filtered set join.

A window is the list of its shingles, runs of ``SHINGLE`` words (all its words, if it has fewer).
They are ordered by rarity, their count over all documents. A document that contains a window
contains all of its shingles, so the prefix of the rarest one is necessary and enough to join
by. Shingles of the documents are joined with these prefix tokens, candidates that would stick
out at either end are dropped (position and length bounds), and the rest are verified word by
word against the whole window. Texts without candidates are only counted, where they are read.

The windows and prefix tokens are written as tables first: whether they are small enough to
broadcast is then decided by the planner from their measured size; beyond its threshold the
same join shuffles.

Defined results: NULL or word-less texts have no words and no hits; NULL item_id counts as an
item named by the empty string; repeated items count once; rows that repeat doc_id and text
get the same result each; an empty table gives an empty result, an empty benchmark no hits;
other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_rows, join_whole, lower_ascii, settle, text_or_empty, with_row_key

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
FILTER = 1 << 20


def words(text: Column | str = "text") -> Column:
    return F.array_remove(F.split(lower_ascii(text_or_empty(text)), NOT_WORD), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id (text), win: each distinct window of each item, its words joined by blanks."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        words().alias("w"),
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))
    return items.select("item_id", F.explode(F.array_distinct(runs)).alias("win")).distinct()


def _shingles(words: str, n: int) -> Column:
    """The runs of n words of the column ``words`` as (place, shingle), a hash of its words."""
    run = lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(n)))
    placed = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.struct(i.alias("place"), run(i).alias("shingle")))
    return F.when(F.size(words) >= n, placed)


def _document_shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, row_key, place, shingle for the runs of each of the ``sizes``."""
    held = docs.select("doc_id", "row_key", words().alias("w"))
    runs = [F.coalesce(_shingles("w", n), F.array()) for n in sizes]
    return held.select("doc_id", "row_key", F.inline(F.concat(*runs) if runs else F.array(F.struct(F.lit(0).alias("place"), F.lit(0).cast("long").alias("shingle")))))


def _prefix_tokens(windows: DataFrame, docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """shingle, win, offset, length: each window under its rarest shingle; and the shingles' sizes."""
    split = windows.select("win").distinct().select("win", F.split("win", " ").alias("w"))
    sizes = sorted(r[0] for r in split.select(F.least(F.size("w"), F.lit(SHINGLE)).alias("n")).distinct().collect())
    shingle = F.coalesce(_shingles("w", SHINGLE), *(_shingles("w", n) for n in range(SHINGLE - 1, 0, -1)))
    placed = split.select("win", F.size("w").alias("length"), F.inline(shingle)).withColumnRenamed("place", "offset")
    vocabulary = settle(placed.select("shingle").distinct())
    counts = settle(
        _document_shingles(docs, sizes).select("shingle").join(vocabulary, "shingle").groupBy("shingle").count()
    )
    prefix = settle(
        placed.join(counts, "shingle")
        .groupBy("win", "length")
        .agg(F.min(F.struct("count", "shingle", "offset")).alias("rarest"), F.count("*").alias("found"))
        # else a shingle is in no document
        .where(F.col("found") == F.greatest(F.lit(1), F.col("length") - (SHINGLE - 1)))
        .select("rarest.shingle", "win", "rarest.offset", "length")
    )
    return prefix, sizes


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, items (sorted): a row for each row of ``docs``."""
    windows = settle(item_windows(benchmark, window))
    docs = with_row_key(docs.select("doc_id", "text"))
    prefix, sizes = _prefix_tokens(windows, docs)
    start = F.col("place") - F.col("offset")
    candidates = settle(
        _document_shingles(docs, sizes)
        .join(prefix, "shingle")
        .where(start >= 0)
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set(F.struct(start.alias("start"), "length", "win")).alias("candidates"))
    )
    # Only texts with candidates travel: others go where they are read, by the occupied ones of
    # FILTER parts of the keys. That is the most rows this broadcast can have.
    part = F.pmod("row_key", F.lit(FILTER).cast("long")).cast("int").alias("part")
    occupied = F.broadcast(candidates.select(part).distinct())
    suspects = docs.select("*", part).join(occupied, "part", "left_semi").drop("part")
    hits = F.filter(
        "candidates",
        lambda c: (c["start"] + c["length"] <= F.size("w"))
        & (F.array_join(F.slice("w", c["start"] + 1, c["length"]), " ") == c["win"]),
    )
    verified = (
        join_rows(suspects, candidates, "inner")
        .select("doc_id", "row_key", words().alias("w"), "candidates")
        .select("doc_id", "row_key", hits.alias("hits"))
        .select(
            "doc_id",
            "row_key",
            _covered("hits").alias("n_hit"),
            F.explode(F.array_distinct(F.transform("hits", lambda h: h["win"]))).alias("win"),
        )
    )
    found = settle(
        verified.join(windows, "win")
        .groupBy("doc_id", "row_key")
        .agg(F.max("n_hit").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    counted = docs.select("doc_id", "row_key", F.size(words()).cast("long").alias("n_words"))
    return join_rows(counted, found).select(
        "doc_id",
        "row_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _covered(hits: str) -> Column:
    """How many positions the hits cover together."""
    return F.aggregate(
        F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), (h["start"] + h["length"]).alias("stop")))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["end"]))).alias("n"),
            F.greatest(a["end"], s["stop"]).alias("end"),
        ),
        lambda a: a["n"].cast("long"),
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    return join_whole(docs, contamination(docs, benchmark).where(contaminated()), "left_anti")
