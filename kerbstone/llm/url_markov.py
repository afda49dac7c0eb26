"""URL filter: ratio of two character language models, one of accepted and one of rejected URLs.

Both are Markov models of variable order (contexts of 3, 2, 1 and 0 characters, Witten-Bell
smoothing from the longer to the shorter). They learn from the URLs that the rules decide, but
for one in ``HELD_OUT`` by its hash. A URL's score is the difference of its two log-likelihoods
divided by its length; the threshold is the score that splits the ruled URLs that were held out
with the least balanced error.

Characters are mapped to 38 symbols, so there are at most 38 ** 4 (2.1 million) rows of four
characters; that bound is why this table, and nothing else, may be broadcast.

Defined results: NULL URLs and those without ``://`` have empty host and path, fit no rule and
score 0; an empty table gives an empty result; without held-out URLs of both kinds the threshold
is 0 and every other URL is allowed; repeated rows get the same result each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, settle, text_or_empty

# Host and path prefix to verdict.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
PLAIN = "abcdefghijklmnopqrstuvwxyz/.-?=&#_:"  # then 0 for digits, ~ for others, ^ for the start
ORDER = 4
HELD_OUT = 5
STEP = 0.01  # of the scores that are tried as threshold


def host() -> Column:
    rest = F.regexp_extract(text_or_empty("url"), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path() -> Column:
    return F.regexp_extract(text_or_empty("url"), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``."""
    fits = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: len(r[0])):
        where, _, rest = text.partition("/")
        there = (F.col("host") == where) | F.col("host").endswith(f".{where}")
        fits = F.when(there & F.col("path").startswith(f"/{rest}"), text).otherwise(fits)
    return fits


def _symbols() -> Column:
    text = F.lower(F.concat("host", "path"))
    digits = F.regexp_replace(text, "[0-9]", "0")
    return F.concat(F.lit("^^^"), F.regexp_replace(digits, r"[^a-z0/.\-?=&#_:]", "~"))


def _grams(texts: DataFrame) -> DataFrame:
    starts = F.sequence(F.lit(1), F.length("symbols") - (ORDER - 1))
    return texts.where(F.length("symbols") >= ORDER).select(
        "symbols",
        "allow",
        "block",
        "held_allow",
        "held_block",
        F.explode(F.transform(starts, lambda i: F.substring("symbols", i, F.lit(ORDER)))).alias("gram"),
    )


def _ratios(grams: DataFrame) -> DataFrame:
    """gram, ratio: log P(last | first three) of the accepted over that of the rejected."""
    kinds = ("allow", "block")
    level = (
        grams.groupBy(F.substring("gram", ORDER, 1).alias("gram"))
        .agg(*(F.sum(k).alias(k) for k in kinds))
    )
    everything = Window.partitionBy()
    level = level.select(
        "gram",
        *(
            ((F.col(k) + 1) / (F.sum(k).over(everything) + len(PLAIN) + 3)).alias(f"p_{k}")
            for k in kinds
        ),
    )
    for n in range(2, ORDER + 1):
        counts = grams.groupBy(F.substring("gram", ORDER + 1 - n, n).alias("gram")).agg(
            *(F.sum(k).alias(k) for k in kinds)
        )
        context = Window.partitionBy(F.substring("gram", 1, n - 1))
        shorter = level.select(
            F.col("gram").alias("shorter"), *(F.col(f"p_{k}").alias(f"q_{k}") for k in kinds)
        )
        seen = {k: F.sum(k).over(context) for k in kinds}
        kinds_after = {k: F.sum((F.col(k) > 0).cast("int")).over(context) for k in kinds}
        level = (
            counts.withColumns({f"n_{k}": seen[k] for k in kinds})
            .withColumns({f"t_{k}": kinds_after[k] for k in kinds})
            .join(shorter, F.substring("gram", 2, n - 1) == F.col("shorter"))
            .select(
                "gram",
                *(
                    F.when(F.col(f"n_{k}") == 0, F.col(f"q_{k}"))
                    .otherwise(
                        (F.col(k) + F.col(f"t_{k}") * F.col(f"q_{k}"))
                        / (F.col(f"n_{k}") + F.col(f"t_{k}"))
                    )
                    .alias(f"p_{k}")
                    for k in kinds
                ),
            )
        )
    return level.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def _threshold(scores: DataFrame) -> float:
    """The score with the least mean of the two error rates over the URLs held out, from a histogram."""
    bins = (
        scores.where(F.col("held_allow") + F.col("held_block") > 0)
        .groupBy(F.floor(F.greatest(F.lit(-20), F.least(F.lit(20), F.col("score"))) / STEP).alias("bin"))
        .agg(F.sum("held_allow").alias("allow"), F.sum("held_block").alias("block"))
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    error = F.coalesce(F.sum("allow").over(below), F.lit(0)) / F.sum("allow").over(everything) + (
        1 - F.coalesce(F.sum("block").over(below), F.lit(0)) / F.sum("block").over(everything)
    )
    # Half-way to the next lower score that a held-out URL has.
    lower = F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin"))
    best = (
        bins.withColumns({"error": error, "middle": (F.col("bin") + lower) / 2})
        .where("error is not null")
        .orderBy("error", F.abs("bin"), "bin")
        .first()
    )
    return best["middle"] * STEP if best else 0.0


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict; their columns of these names go."""
    own = ("host", "path", "rule", "score", "verdict", "symbols")
    given = dict(rules)
    ruled = (
        pages.drop(*own)
        .withColumns({"host": host(), "path": path()})
        .withColumns({"rule": rule(rules), "symbols": _symbols()})
    )
    decided = F.lit(None).cast("string")
    for text, verdict in given.items():
        decided = F.when(F.col("rule") == text, verdict).otherwise(decided)
    held = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    kinds = {"allow": ~F.col("held"), "block": ~F.col("held"), "held_allow": F.col("held"), "held_block": F.col("held")}
    texts = settle(
        ruled.select("symbols", decided.alias("decided"), held.alias("held"))
        .groupBy("symbols")
        .agg(*(F.count(F.when((F.col("decided") == k.removeprefix("held_")) & side, 1)).alias(k) for k, side in kinds.items()))
    )
    grams = _grams(texts)
    counts = settle(
        grams.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    )
    ratios = settle(_ratios(counts))
    scores = settle(
        grams.join(F.broadcast(ratios), "gram")
        .groupBy("symbols")
        .agg(
            (F.sum("ratio") / F.count("*")).alias("score"),
            F.first("held_allow").alias("held_allow"),
            F.first("held_block").alias("held_block"),
        )
    )
    least = _threshold(scores)
    learned = F.when(F.col("score") >= least, "allow").otherwise("block")
    return (
        ruled.join(scores.select("symbols", "score"), "symbols", "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .withColumn("verdict", F.coalesce(decided, learned))
        .drop("symbols")
    )
