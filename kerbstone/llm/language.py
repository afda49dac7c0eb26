"""Language by Bayesian fusion of a text's likelihood with what its page says about it.

Hypotheses are ``LANGUAGES`` and ``und``, under which all three-byte runs are equally likely.
The posterior is the product of

* the text's likelihood: counts of hashed three-byte runs of letters and blanks by language over all labelled
  documents, add-half smoothed; long texts count as ``EVIDENCE`` runs, as runs overlap;
* the likelihoods of the declared markup language, of the address's suffix (last label of the
  host) and of its section (first path segment), learned by grouped counts against the
  languages that the texts alone suggest;
* the host's prior: its counts shrunk towards its parent domain's, and those towards all.

A text is rejected if it has no letters, or if ``und`` or a posterior under ``LEAST`` wins.

A page belongs to the document whose number is the first number in its address's path; documents without
a page have their source as host and no other evidence. Texts are read by Spark tasks that
emit a few numbers a document; everything after that is joins of narrow rows.

Defined results: NULL and empty texts are rejected; NULL source is a host of its own; labels
other than ``LANGUAGES`` teach nothing, and a language without labelled documents never wins over
one with; of several pages with one number the least address
counts; repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_whole, lower_ascii, settle, text_or_empty, with_row_key
from .tasks import text_chunks

LANGUAGES = ("de", "en", "es", "fr")
HYPOTHESES = (*LANGUAGES, "und")
RUNS = 1 << 15
EVIDENCE = 300
LEAST = 0.5
STRENGTH = 20.0  # documents that a parent's shares count as
UND = 1e-4  # prior
UNTAUGHT = -50.0  # log P of any run in a language that no document is labelled with
_LETTER = np.zeros(256, bool)
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r\v\f")] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _runs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed three-byte runs of all texts, the text of each run, and letters in each text."""
    framed = [b" " + t.lower() + b" " if t else b"" for t in texts]
    lengths = np.array([len(t) for t in framed])
    data = np.frombuffer(b"".join(framed), np.uint8)
    of = np.repeat(np.arange(len(texts)), lengths)
    wide = data.astype(np.uint32)
    runs = ((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(17)
    # Only letters and blanks say something: no digits, marks or addresses.
    letter, blank = _LETTER[data], _BLANK[data]
    plain = letter | blank
    same = (of[:-2] == of[2:]) & plain[:-2] & plain[1:-1] & plain[2:] & (letter[:-2] | letter[1:-1])
    letters = np.bincount(of[letter], minlength=len(texts))
    return runs[same], of[:-2][same], letters


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(LANGUAGES), RUNS), np.int64)
    for batch in batches:
        number = np.array([LANGUAGES.index(x) for x in batch.column("lang").to_pylist()], np.int64)
        at = 0
        for texts in text_chunks(batch.column("text")):
            runs, of, _ = _runs(texts)
            key = number[at : at + len(texts)][of] * RUNS + runs
            total += np.bincount(key, minlength=total.size).reshape(total.shape)
            at += len(texts)
    language, run = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(language), pa.array(run), pa.array(total[language, run])],
        names=["language", "run", "n"],
    )


def text_model(docs: DataFrame) -> np.ndarray:
    """log P(run | hypothesis), a row for each hypothesis, from all documents with a label."""
    found = (
        docs.where(F.col("lang").isin(*LANGUAGES))
        .select("lang", F.col("text").cast("binary").alias("text"))
        .mapInArrow(_counted, "language long, run long, n long")
        .groupBy("language", "run")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # LANGUAGES times RUNS at most
    )
    counts = np.full((len(HYPOTHESES), RUNS), 0.5)
    counts[found.column("language").to_numpy(), found.column("run").to_numpy()] += found.column("n").to_numpy()
    counts[-1] = 1
    model = np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)
    model[counts.sum(1) == RUNS / 2] = UNTAUGHT
    return model


def _judged(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_chunks(batch.column("text")):
                runs, of, letters = _runs(texts)
                n = np.bincount(of, minlength=len(texts))
                scale = np.minimum(n, EVIDENCE) / np.maximum(n, 1)
                sums = [np.bincount(of, row[runs], len(texts)) * scale for row in model]
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(3)), pa.array(letters), *map(pa.array, sums)],
                    names=[*rows.schema.names[:3], "letters", *(f"text_{h}" for h in HYPOTHESES)],
                )
                at += len(texts)

    return run


def page_evidence(pages: DataFrame) -> DataFrame:
    """number, host, suffix, section, markup: one row for each number."""
    url = text_or_empty("url")
    markup = F.lower(F.regexp_extract(text_or_empty("html"), r"(?is)<html[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    host = lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return (
        pages.select(
            F.regexp_extract(url, r"(?s)^.*?://[^/?#]*/(?:[^?#]*?/)?(\d{1,18})", 1).try_cast("long").alias("number"),
            F.struct(
                url.alias("url"),
                host.alias("host"),
                F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
                F.regexp_extract(url, r"(?s)^.*?://[^/?#]*/([a-zA-Z]{2})(?:[/?#]|$)", 1).alias("section"),
                markup.alias("markup"),
            ).alias("page"),
        )
        .where("number is not null")
        .groupBy("number")
        .agg(F.min("page").alias("page"))
        .select("number", "page.host", "page.suffix", "page.section", "page.markup")
    )


def _best(prefix: str) -> Column:
    """The hypothesis with the largest column; the first of equals."""
    top = F.greatest(*(F.col(f"{prefix}{h}") for h in HYPOTHESES))
    name = F.lit("und")
    for h in reversed(LANGUAGES):
        name = F.when(F.col(f"{prefix}{h}") == top, h).otherwise(name)
    return name


def _counts(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(value).agg(
        *(F.count(F.when(F.col("text_lang") == h, 1)).alias(f"n_{h}") for h in LANGUAGES)
    )


def _likelihood(rows: DataFrame, value: str, totals: dict[str, int]) -> DataFrame:
    """value, and log P(value | hypothesis): half a document is added everywhere."""
    return _counts(rows.where(F.coalesce(value, F.lit("")) != ""), value).select(
        F.col(value).alias("given"),
        *(F.log((F.col(f"n_{h}") + 0.5) / (totals[h] + 1)).alias(f"{value}_{h}") for h in LANGUAGES),
    )


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, row_key, text_lang, host, markup, language, posterior, kept: a row for each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    judged = with_row_key(docs.select("doc_id", "text", "source")).select(
        "doc_id", "row_key", F.col("source").cast("string").alias("source"),
        F.col("text").cast("binary").alias("text"),
    ).mapInArrow(
        _judged(text_model(docs)),
        f"doc_id {id_type}, row_key long, source string, letters long, "
        + ", ".join(f"text_{h} double" for h in HYPOTHESES),
    )
    evidence = page_evidence(pages)
    host = F.coalesce("host", F.concat(F.lit("source:"), F.coalesce("source", F.lit("")))) 
    rows = settle(
        judged.join(evidence, F.col("doc_id") == F.col("number"), "left")
        .drop("number")
        .withColumn("host", host)
        .withColumn("parent", F.regexp_extract("host", r"^[^.]*\.(.+)$", 1))
        .withColumn("text_lang", _best("text_"))
    )
    totals = rows.agg(
        *(F.count(F.when(F.col("text_lang") == h, 1)).alias(h) for h in LANGUAGES)
    ).first().asDict()
    known = sum(totals.values())
    whole = {h: (totals[h] + 1) / (known + len(LANGUAGES)) for h in LANGUAGES}

    def shrunk(h: str, n: Column, towards: Column | float) -> Column:
        return (F.col(f"n_{h}") + STRENGTH * towards) / (n + STRENGTH)

    n = sum((F.col(f"n_{h}") for h in LANGUAGES[1:]), F.col(f"n_{LANGUAGES[0]}"))
    parents = _counts(rows, "parent").select(
        F.col("parent").alias("of"), *(shrunk(h, n, whole[h]).alias(f"parent_{h}") for h in LANGUAGES)
    )
    hosts = (
        _counts(rows.select("host", "text_lang"), "host")
        .withColumn("of", F.regexp_extract("host", r"^[^.]*\.(.+)$", 1))
        .join(parents, "of")
        .select(
            F.col("host").alias("given"),
            *(F.log((1 - UND) * shrunk(h, n, F.col(f"parent_{h}"))).alias(f"host_{h}") for h in LANGUAGES),
        )
    )
    tables = {"host": settle(hosts)}
    for value in ("markup", "suffix", "section"):
        tables[value] = settle(_likelihood(rows, value, totals))
    for value, table in tables.items():
        rows = rows.join(table, F.col(value) == F.col("given"), "left").drop("given")
    # Under und every value is as likely as on the average of the languages.
    for h in LANGUAGES:
        parts = [F.coalesce(f"{value}_{h}", F.lit(0.0)) for value in tables]
        rows = rows.withColumn(f"all_{h}", sum(parts, F.col(f"text_{h}")))
    average = [
        F.coalesce(sum((F.col(f"{v}_{h}") for h in LANGUAGES[1:]), F.col(f"{v}_{LANGUAGES[0]}")) / len(LANGUAGES), F.lit(0.0))
        for v in ("markup", "suffix", "section")
    ]
    rows = rows.withColumn("all_und", sum(average, F.col("text_und")) + float(np.log(UND)))
    top = F.greatest(*(F.col(f"all_{h}") for h in HYPOTHESES))
    spread = sum((F.exp(F.col(f"all_{h}") - top) for h in HYPOTHESES), F.lit(0.0))
    return (
        rows.withColumn("language", _best("all_"))
        .withColumn("posterior", 1 / spread)
        .withColumn(
            "kept", (F.col("letters") > 0) & (F.col("language") != "und") & (F.col("posterior") >= LEAST)
        )
        .select("doc_id", "row_key", "text_lang", "host", "markup", "language", "posterior", "kept")
    )


def accepted(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is known, with all their columns."""
    rejected = identify(docs, pages).where("not kept").select("doc_id", "row_key").distinct()
    return join_whole(docs, settle(rejected), "left_anti")
