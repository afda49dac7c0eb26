"""The trie of conversation prefixes by ROLLUP over positional turn-id columns.

A turn's id is a digest of its role and text. A conversation is laid out as blocks of ``BLOCK``
columns t1, t2 ... of turn ids. Within a block GROUP BY ..., ROLLUP(t1, t2 ...) aggregates the
conversations of all its prefixes together, and grouping_id tells a prefix's length. Blocks
after the first are keyed by the node at which the block before them ended, so a conversation
of any length is one row a block and all blocks are rolled up in the same job. A node is known
by its depth and two running 64-bit sums (by exclusive or) of place and turn id, from which a
block's key and a node's parent follow without walking the trie.

Sums over subtrees need no walk either. Every node belongs to its smallest member; from some
depth downwards a conversation owns all nodes on its path. What a conversation owns (words of
its nodes, a leaf) is known after the first rollup, and a second one sums it over the members
of every prefix: the distinct nodes below a prefix are those its members own.

Work grows with the number of turns. Partial aggregation leaves one row a task of a prefix that
a third of all conversations begin with. A long conversation is numbered and keyed by windows,
which spill, and never gathered in a row. The ids of conversations that end at a node are
joined by runs of ``RUN`` ids and hashed run by run, so that no list of them is held.

Defined results: NULL conv_id takes no part; turns of a conversation with equal numbers are
ordered by their digests; turns that repeat number, role and text stay turns of their own; NULL
turn numbers come first; NULL role and text are empty; an empty table gives an empty result;
other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, text_or_empty

BLOCK = 8
RUN = 1 << 16
TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]
NODE = ("depth", "x", "y")

# --- turns ----------------------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn_id, words: the turns of each conversation in order.

    turn_id holds a digest of role and text, and the number of words behind a colon.
    """
    role, text = text_or_empty(F.col("role").cast("string")), text_or_empty()
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), words.cast("long").alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return turns.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("place"),
        F.concat_ws(":", "digest", "words").alias("turn_id"),
        "words",
    )


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first of their ``group``, and their lengths.

    The first h turns are those of conversation c - c % group, h = crc32(c) % ``most``; then
    come c's own turns after its first h. Returns the turns and (conv_id, n_turns), which also
    has conversations without turns.
    """
    counts = settle(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    head = (F.crc32(F.col("conv_id").cast("string")) % most).alias("h")
    first = counts.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    plans = settle(
        counts.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("first"), head)
        .join(first, "first", "left")
        .withColumn("taken", F.least("h", F.coalesce("n_first", F.lit(0))))
    )
    heads = turns.where((F.col("place") < most) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "first")
    borrowed = (
        plans.where("taken > 0")
        .select("conv_id", "first", F.explode(F.sequence(F.lit(1), F.col("taken"))).alias("place"))
        .join(heads, ["first", "place"])
        .select("conv_id", "place", "turn_id", "words")
    )
    own = (
        turns.join(plans.select("conv_id", "h", "taken"), "conv_id")
        .where(F.col("place") > F.col("h"))
        .select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "turn_id", "words")
    )
    lengths = plans.select(
        "conv_id", (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).cast("long").alias("n_turns")
    )
    return own.unionByName(borrowed), lengths


# --- blocks ---------------------------------------------------------------------------------


def _part(seed: int, place: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(seed), place, turn)


def blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv_id, n_turns, total, block, x, y, before, t1 ... : each conversation's blocks.

    x and y are the running digests, before the running words, of all turns before the block;
    total are the conversation's words. A conversation without turns has one empty block.
    """
    whole = Window.partitionBy("conv_id")
    so_far = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("place") - 1
    running = turns.select(
        "conv_id",
        "turn_id",
        F.floor(place / BLOCK).cast("long").alias("block"),
        (place % BLOCK).alias("at"),
        *(F.coalesce(F.bit_xor(_part(s, F.col("place"), F.col("turn_id"))).over(so_far), F.lit(0)).alias(c) for s, c in ((1, "x"), (2, "y"))),
        F.coalesce(F.sum("words").over(so_far), F.lit(0)).alias("before"),
        F.col("words"),
    )
    at_start = lambda c: F.max(F.when(F.col("at") == 0, F.col(c))).alias(c)
    laid = running.groupBy("conv_id", "block").agg(
        at_start("x"), at_start("y"), at_start("before"), F.sum("words").alias("words"),
        *(F.max(F.when(F.col("at") == i, F.col("turn_id"))).alias(c) for i, c in enumerate(TURNS)),
    )
    none = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    joined = lengths.join(laid, "conv_id", "left")
    return joined.select(
        "conv_id",
        "n_turns",
        F.coalesce(F.sum("words").over(whole), F.lit(0)).alias("total"),
        *(none(c, 0) for c in ("block", "x", "y", "before")),
        *TURNS,
    )


def roll_up(rows: DataFrame, aggregates: str) -> DataFrame:
    """The blocks' prefixes with ``aggregates`` over the conversations that have them.

    A grouping_id of k ones at the end stands for a prefix without the last k turns. Prefixes
    longer than the conversation (its columns are NULL) are none, and the empty prefix of a
    later block is the node at which the block before it ended.
    """
    grouped = rows.sparkSession.sql(
        f"""
        SELECT block, x, y, before, {", ".join(TURNS)}, grouping_id() AS gid, {aggregates}
        FROM {{rows}}
        GROUP BY block, x, y, before, ROLLUP({", ".join(TURNS)})
        """,
        rows=rows,
    )
    kept = F.bit_count("gid")
    depth = BLOCK - kept
    last = reduce(lambda found, i: F.when(depth == i, F.col(TURNS[i - 1])).otherwise(found), range(1, BLOCK + 1), F.lit(None))
    real = grouped.withColumn("inside", depth.cast("long")).withColumn("last", last)
    return real.where("last is not null or inside = 0 and block = 0")


def _named(groups: DataFrame) -> DataFrame:
    """Adds a node's depth, digests, those of its parent, and the words of its turns."""

    def digest(seed: int, start: str, without_last: bool) -> Column:
        end = F.col("inside") - int(without_last)
        out = F.col(start)
        for i, c in enumerate(TURNS, 1):
            part = _part(seed, F.col("block") * BLOCK + i, F.col(c))
            out = out.bitwiseXOR(F.when(F.lit(i) <= end, part).otherwise(F.lit(0)))
        return out

    words = lambda c: F.coalesce(F.substring_index(c, ":", -1).cast("long"), F.lit(0))
    above = sum((F.when(F.lit(i) < F.col("inside"), words(F.col(c))).otherwise(0) for i, c in enumerate(TURNS, 1)), F.col("before"))
    return groups.select(
        "*",
        (F.col("block") * BLOCK + F.col("inside")).alias("depth"),
        above.alias("words_above"),
        words(F.col("last")).alias("words_last"),
        digest(1, "x", False).alias("node_x"), digest(2, "y", False).alias("node_y"),
        digest(1, "x", True).alias("up_x"), digest(2, "y", True).alias("up_y"),
    )


# --- where conversations end -----------------------------------------------------------------


def ends(rows: DataFrame) -> DataFrame:
    """depth, x, y, ends_sha256 of the nodes at which conversations end."""
    last = rows.where((F.col("n_turns") > F.col("block") * BLOCK) & (F.col("n_turns") <= (F.col("block") + 1) * BLOCK) | (F.col("n_turns") == 0))
    at_end = _named(
        last.withColumn("inside", F.col("n_turns") - F.col("block") * BLOCK).withColumn("last", F.lit(None).cast("string"))
    ).select("conv_id", "depth", F.col("node_x").alias("x"), F.col("node_y").alias("y"))
    run = F.floor(F.col("conv_id") / RUN).cast("long")
    runs = at_end.groupBy(*NODE, run.alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    return (
        runs.repartition(*NODE)
        .sortWithinPartitions(*NODE, "run")
        .mapInArrow(_hashed, "depth long, x long, y long, ends_sha256 string")
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids, sorted, to one digest a node; the digest of one node is held at a time."""
    node, digest = None, hashlib.sha256()
    for batch in batches:
        found: list[tuple] = []
        for *this, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if this == node:
                digest.update(b",")
            else:
                if node:
                    found.append((*node, digest.hexdigest()))
                node, digest = this, hashlib.sha256()
            digest.update(ids.encode())
        yield _nodes(found)
    if node:
        yield _nodes([(*node, digest.hexdigest())])


def _nodes(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found) if found else ((),) * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*NODE, "ends_sha256"])


# --- the operator -----------------------------------------------------------------------------


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each node: the contract's columns, and the node's digests x, y and up_x, up_y.

    ``turns`` as of ``numbered_turns``; ``lengths`` has every conversation, also without turns.
    """
    rows = settle(blocks(turns, lengths))
    nodes = settle(
        _named(roll_up(rows, "count(*) AS n_convs, min(conv_id) AS conv_id, max(n_turns) AS longest")).select(
            "depth", F.col("node_x").alias("x"), F.col("node_y").alias("y"), "up_x", "up_y",
            "conv_id", "n_convs", "words_last", (F.col("longest") == F.col("depth")).alias("leaf"),
        )
    )
    # What each conversation owns: the nodes from the first depth at which it is the smallest.
    owned = nodes.groupBy(F.col("conv_id").alias("owner")).agg(
        F.sum("words_last").alias("owned_words"), F.max(F.col("leaf").cast("long")).alias("owned_leaves")
    )
    owners = rows.join(owned, F.col("conv_id") == F.col("owner"), "left").drop("owner").fillna(0, ["owned_words", "owned_leaves"])
    below = _named(
        roll_up(
            owners,
            "sum(total) AS all_words, sum(owned_words) AS all_owned, sum(owned_leaves) AS n_leaves, "
            "count(*) AS n, min(struct(conv_id, owned_words, total)) AS least",
        )
    ).select(
        "depth", F.col("node_x").alias("x"), F.col("node_y").alias("y"), "n_leaves",
        # every member's words from this node on, less the words of the distinct nodes from here on
        (
            F.col("all_words") - F.col("n") * F.col("words_above")
            - (F.col("all_owned") - F.col("least.owned_words") + F.col("least.total") - F.col("words_above"))
        ).alias("saved_tokens"),
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("parent_conv_id")
    )
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")).agg(
        F.count("*").alias("n_children")
    )
    return (
        nodes.join(below, list(NODE))
        .join(children, list(NODE), "left")
        .join(ends(rows), list(NODE), "left")
        .join(parents, ["depth", "up_x", "up_y"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
            "x", "y", "up_x", "up_y",
        )
    )
