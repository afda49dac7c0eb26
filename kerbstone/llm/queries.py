"""The operators as registered queries, each over its whole tables, and the SQL that exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bilinear_lm, bit_codes, cover_tree, decontaminate, host_rules, language, mix, path_join, prefix_trie, previous_factor,
    quality_vote, token_cache, url_markov,
)
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_quality_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_vote.score(documents(spark, sf_dir), labels)


def op2_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear_lm.score(documents(spark, sf_dir))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rate", "n_failures", "allowed",
    )


def op4_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_join.near_duplicates(documents(spark, sf_dir), percent=85).drop("text_key")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return language.identify(documents(spark, sf_dir), pages).drop("row_key")


def op6_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_markov.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(documents(spark, sf_dir), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_previous_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return previous_factor.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_cache.count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered_turns(conversations))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return cover_tree.hard_negatives(cover_tree.candidates(embeddings))


def op13_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return bit_codes.nearest(bit_codes.participants(embeddings))


QUERIES: dict[str, Query] = {
    "op1_quality_vote": op1_quality_vote,
    "op2_bilinear_lm": op2_bilinear_lm,
    "op3_host_rules": op3_host_rules,
    "op4_path_join": op4_path_join,
    "op5_language": op5_language,
    "op6_url_markov": op6_url_markov,
    "op7_decontaminate": op7_decontaminate,
    "op8_mix": op8_mix,
    "op9_previous_factor": op9_previous_factor,
    "op10_token_cache": op10_token_cache,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_cover_tree": op12_cover_tree,
    "op13_bit_codes": op13_bit_codes,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source_key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS order_key
  FROM documents),
totals AS (SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY ALL),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source_key) - 1) % 3 + 1 AS weight, source_size * 3 AS cap
  FROM totals),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS everything,
         CAST(coalesce(sum(cap) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before,
         CAST(sum(weight) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS onward
  FROM ranked WINDOW rising AS (ORDER BY cap / weight, source_key)),
goals AS (
  SELECT source_key, source_size,
         CASE WHEN cap / weight <= (everything - before) / onward THEN CAST(cap AS DOUBLE)
              ELSE weight * max((everything - before) / onward)
                   FILTER (WHERE NOT cap / weight <= (everything - before) / onward) OVER () END AS target
  FROM levels),
placed AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs,
         coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY order_key, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized JOIN goals USING (source_key))
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, floor(target) - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed
"""

DECONTAMINATE_SQL = (
    r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all("""
    + _LOWERED
    + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS win, least(len(w), 13) AS n
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT doc_id, regexp_extract_all("""
    + _LOWERED
    + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
runs AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, runs.n, item_id FROM runs JOIN windows USING (win)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
)

# The unsigned CRC-32 of a conversation's number: eight steps a bit at a time for each character.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST(range(8) AS BIGINT[])),
                               lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE_SQL = (
    r"""
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(len(role) || ':' || role || text)) AS s
  FROM said GROUP BY conv_id),
heads AS (SELECT conv_id, s, CAST("""
    + _CRC
    + r""" % 4 AS BIGINT) AS h FROM convs),
rebuilt AS (
  SELECT c.conv_id, list_concat(list_slice(coalesce(f.s, []), 1, h), list_slice(c.s, h + 1, len(c.s))) AS s
  FROM heads AS c LEFT JOIN convs AS f ON f.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(s) AS n, d, list_slice(s, 1, d) AS p FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d) AS ends
  FROM prefixes GROUP BY p, d),
kids AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT p, d, n_children IS NULL AS leaf,
         CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes LEFT JOIN kids USING (p)),
below AS (
  SELECT list_slice(p, 1, k) AS p, CAST(count(*) FILTER (leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM valued) GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes AS n JOIN below USING (p) LEFT JOIN kids USING (p)
LEFT JOIN nodes AS u ON n.d > 0 AND u.d = n.d - 1 AND u.p = list_slice(n.p, 1, n.d - 1)
"""
)

NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scored AS n
  ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

#: The other queries hold models or similarity joins; tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op7_decontaminate": DECONTAMINATE_SQL,
    "op8_mix": MIX_SQL,
    "op11_prefix_trie": TRIE_SQL,
    "op12_cover_tree": NEGATIVES_SQL,
}
