"""Token counts through a digest cache.

A text's count is stored under the digest of its content and the digest of the tokenizer
(file and library version). Content is normalised only where no token can change: NULL and
empty are one. Digests of all rows are joined with the stored counts; each missing digest is
encoded once, whatever its number of copies, and appended to the cache. The folder given, or
the one that the setting ``CACHE_SETTING`` names, lasts over runs; without either it is new.

To find one text for each missing digest the texts travel compressed. Partial aggregation keeps
one copy a task, so a text that a third of all rows repeat is not a hot key there. Nor is it where
rows meet their counts: digests that at least one row in ``COMMON`` has, ``COMMON`` of them at
most, get theirs from a broadcast table, and their rows join by a key of their own id.

``docs`` is read twice, for digests and for texts, and has to give the same rows both times: a row
that is there the first time only (a ``limit`` without an order) gets no count and no result.

Defined results: NULL text is empty text and has 0 tokens; repeated rows get the same count; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from importlib.metadata import version

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import settle, shared_folder, text_or_empty

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
CACHE_SETTING = "spark.kerbstone.tokenCache"
COMMON = 1000
BATCH = 2_000_000  # bytes of text that are encoded at once


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        content = hashlib.sha256(f.read())
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    content.update(f"{library} {version(library)}".encode())
    return content.hexdigest()


def _counter(path: str):
    """texts to numbers of tokens, as the tokenizer's own library gives them."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[int]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [len(e) for e in found]

    return _PieceCounter(encode, tokenizer) if _splits_at_blanks(tokenizer) else encode


def _splits_at_blanks(tokenizer) -> bool:
    """Whether a blank or newline between two other characters always starts a new piece.

    So it is for byte-level BPE with the library's own pattern, no normaliser, no prefix blank.
    """
    made = json.loads(tokenizer.to_str())
    level = made["pre_tokenizer"] or {}
    return (
        made["normalizer"] is None
        and level.get("type") == "ByteLevel"
        and not level.get("add_prefix_space")
        and level.get("use_regex", True)
        and (made["post_processor"] or {}).get("type", "ByteLevel") == "ByteLevel"
    )


class _PieceCounter:
    """Counts by pieces between single blanks, each distinct piece encoded once.

    A text with any other white space, two of them in a row, or one of the tokenizer's added
    strings is encoded whole.
    """

    ODD_SPACE = re.compile(r"\s\s|[^\S \n]|[\x1c-\x1f\x85]")
    MOST = 1_000_000  # pieces that are kept; then the memory starts anew

    def __init__(self, encode, tokenizer):
        self.encode = encode
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        whole = [i for i, t in enumerate(texts) if self._is_odd(t)]
        odd = set(whole)
        split = {
            i: [line.split(" ") for line in t.split("\n")]
            for i, t in enumerate(texts)
            if i not in odd
        }
        self._learn(split.values())
        counts = dict(zip(whole, self.encode([texts[i] for i in whole])))
        first, later = self.first.__getitem__, self.later.__getitem__
        for i, lines in split.items():
            counts[i] = len(lines) - 1 + sum(
                first(words[0]) + sum(map(later, words[1:])) for words in lines
            )
        if len(self.first) + len(self.later) > self.MOST:
            self.first, self.later = {}, {}
        return [counts[i] for i in range(len(texts))]

    def _is_odd(self, text: str) -> bool:
        return bool(self.ODD_SPACE.search(text)) or any(a in text for a in self.added)

    def _learn(self, documents: Iterable[list[list[str]]]) -> None:
        first: set[str] = set()
        later: set[str] = set()
        for lines in documents:
            for words in lines:
                first.add(words[0])
                later.update(words[1:])
        for new, known, lead in ((first, self.first, ""), (later, self.later, " ")):
            pieces = list(new - known.keys())
            known.update(zip(pieces, self.encode([lead + p for p in pieces])))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array(map(pack, texts), pa.binary())],
            names=["digest", "packed"],
        )


def _encoded(path: str, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, unpack = _counter(path), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            numbers: list[int] = []
            texts: list[str] = []
            waiting = 0
            for packed in batch.column("packed").to_pylist():
                text = unpack(packed)
                texts.append(text.decode("utf-8", "replace"))
                waiting += len(text)
                if waiting > BATCH:
                    numbers += count(texts)
                    texts, waiting = [], 0
            numbers += count(texts) if texts else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("digest"),
                    pa.array(numbers, pa.int64()),
                    pa.array([tokenizer] * len(numbers), pa.string()),
                ],
                names=["digest", "n_tokens", "tokenizer"],
            )

    return run


def _stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    # A run that failed after its append may have left a digest twice.
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens")
    )


def _with_counts(digests: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows with their counts; no task gets all rows of a common digest."""
    number = digests.groupBy("digest").agg(F.count("*").alias("n"))
    total = digests.count()
    common = (
        settle(number.where(F.col("n") * COMMON >= total).select("digest"))
        .join(stored, "digest")
        .withColumnsRenamed({"digest": "common", "n_tokens": "n_common"})
    )
    marked = digests.join(F.broadcast(common), F.col("digest") == F.col("common"), "left")  # COMMON rows at most
    # A key no stored digest has: those are of 32 bytes.
    spread = F.unhex(F.hex(F.xxhash64(F.col("doc_id").cast("string"))))
    rest = marked.withColumn("digest", F.when(F.col("common").isNull(), F.col("digest")).otherwise(spread))
    counted = rest.join(stored, "digest", "left").withColumn("n_tokens", F.coalesce("n_common", "n_tokens"))
    return counted.where("n_tokens is not null")  # as an inner join: every digest read is stored


def count_tokens(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens: a row for each row of ``docs``. ``cache``: a folder that grows."""
    spark = docs.sparkSession
    cache = cache or spark.conf.get(CACHE_SETTING, None) or f"{shared_folder(spark)}/cache"
    tokenizer = tokenizer_digest(path)
    content = text_or_empty().cast("binary")
    digest = F.unhex(F.sha2(content, 256))
    digests = settle(
        docs.select("doc_id", F.octet_length(content).cast("long").alias("n_bytes"), digest.alias("digest"))
    )
    texts = docs.select(digest.alias("digest"), content.alias("text"))
    # One packed text for each digest; those that are stored go before they are encoded.
    missing = (
        texts.mapInArrow(_packed, "digest binary, packed binary")
        .groupBy("digest")
        .agg(F.first("packed").alias("packed"))
        .join(_stored(spark, cache, tokenizer).select("digest"), "digest", "left_anti")
    )
    missing.mapInArrow(_encoded(path, tokenizer), CACHE_SCHEMA).write.mode("append").parquet(cache)
    return _with_counts(digests, _stored(spark, cache, tokenizer)).select(
        "doc_id", "n_bytes", "n_tokens"
    )
