"""The operators against brute force on a small fixture with odd rows, and on other edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbstone.llm import (
    bilinear_lm, decontaminate, graph, host_rules, language, mix, path_join, previous_factor,
    quality_vote, token_cache, url_markov,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, host string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _texts() -> list[str | None]:
    r = random.Random(3)
    words = [f"{r.choice('Abcdefg')}{r.choice('aeiouäé')}{i % 97}x"[: r.randint(2, 6)] for i in range(400)]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, base = some(60), some(120).split()
    texts: list[str | None] = [None, "", " \n\t ", "one two", "one  two ", some(5)]
    texts += [some(r.randint(10, 200)) for _ in range(20)]
    texts += [some(20) + " " + passage + "\n" + some(15) for _ in range(6)]
    texts += [texts[8]] * 5  # exact copies
    for _ in range(12):  # near copies
        near = list(base)
        for _ in range(r.randint(0, 3)):
            near[r.randrange(len(near))] = r.choice(words)
        texts.append(" ".join(near))
    texts += ["ab " * 3000, (some(9) + "\n") * 30, "a<|endoftext|> b", "É é É\u2003x", some(30000)]
    return texts


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "s1", "s2", "hot", "hot")[i % 5], 1, 0.5, "x") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here at all", "en", "s1", 1, 0.5, "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame) -> dict:
    return {r["doc_id"]: r for r in frame.collect()}


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# --- 1 ---


def test_quality_vote_learns_from_what_is_not_held_out(spark, docs, no_docs):
    good = [(i, f"A calm sentence, number {i}. It goes on, and ends.\nThen another one.", i % 2) for i in range(0, 80, 2)]
    bad = [(i, "Buy buy buy buy buy!!! $$$ | | | " * (1 + i % 3), 0) for i in range(1, 80, 2)]
    rows = [(i, t, None, None, 1, 0.0, "") for i, t, _ in good + bad]
    frame = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(80)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    found = by_id(quality_vote.score(frame, labels))
    for i in range(80):
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert found[i]["predicted"] == (i + 1) % 2, i
    odd = by_id(quality_vote.score(docs, labels))
    assert len(odd) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in odd.values())
    assert quality_vote.score(no_docs, labels).count() == 0
    assert {r["score"] for r in quality_vote.score(docs, labels.limit(0)).collect()} == {0.5}


def test_words_alone_can_tell_labels_apart(spark):
    r = random.Random(5)
    ours, theirs = ["kato", "melu", "sori", "pane", "dilo"], ["luka", "rite", "noma", "vedo", "gasi"]  # alike in kinds
    rows = [(i, " ".join(r.choice(theirs if i % 2 else ours) for _ in range(40)), None, None, 1, 0.0, "") for i in range(120)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id long, quality int")
    found = by_id(quality_vote.score(spark.createDataFrame(rows, SCHEMA), labels))
    assert all(found[i]["predicted"] == 1 - i % 2 for i in range(120))


def test_terms_are_those_of_plain_counting():
    texts = [(t or "").encode() for t in TEXTS[:30]]
    counts = quality_vote.term_counts([t or None for t in texts])
    first, stop = quality_vote.RUNS, quality_vote.RUNS + quality_vote.WORDS
    for row, text in zip(counts, texts):
        words = [zlib.crc32(w) for w in text.split()]
        single = Counter(w % quality_vote.WORDS for w in words)
        double = Counter((a * 31 + b) % quality_vote.PRIME % quality_vote.WORDS for a, b in zip(words, words[1:]))
        assert dict(single) == {i: row[first + i] for i in range(quality_vote.WORDS) if row[first + i]}
        assert dict(double) == {i: row[stop + i] for i in range(quality_vote.WORDS) if row[stop + i]}
        lines = [line for line in text.split(b"\n") if line]
        assert row[-3:].tolist() == [5 * (len(lines) - len(set(lines))), len(words) - len(set(words)), len(words)]
        backs = [sum(a == b for a, b in zip(words, words[k:])) for k in range(1, quality_vote.BACK + 1)]
        assert row[-quality_vote.EVENTS : -3].tolist() == backs


def test_votes_are_those_of_plain_loops(monkeypatch):
    monkeypatch.setattr(quality_vote, "NEIGHBOURS", 7)
    counts = quality_vote.term_counts([(t or "").encode() for t in TEXTS])
    labels = np.array([i % 3 == 0 for i in range(len(TEXTS))], int)
    shares = (0.8, 0.2)
    model = quality_vote.learn(counts, labels, shares)
    weighted = quality_vote._weighted(counts, model["idf"]).astype(np.float64)
    points = weighted @ model["basis"]
    # The basis is that of the singular value decomposition: no other keeps more of the rows.
    kept = (np.linalg.svd(weighted, compute_uv=False)[: points.shape[1]] ** 2).sum()
    assert (points**2).sum() == pytest.approx(kept, rel=1e-4)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    number = Counter(labels.tolist())
    for i, given in enumerate(quality_vote.vote(model, counts)):
        cosines = sorted(((float(points[i] @ points[j]), j) for j in range(len(TEXTS))), reverse=True)
        last = cosines[6][0]
        if cosines[7][0] > last - 1e-5:
            continue  # equal neighbours: either may vote
        votes = {0: 0.0, 1: 0.0}
        for cosine, j in cosines[:7]:
            label = int(labels[j])
            votes[label] += max(cosine, 1e-6) ** quality_vote.SHARPNESS * shares[label] / number[label]
        assert given == pytest.approx(votes[1] / (votes[0] + votes[1]), abs=1e-3), i


# --- 2 ---


def test_language_model_base_counts_and_probabilities(docs, no_docs):
    import math

    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(TEXTS))}
    every = [*enumerate(TEXTS), (None, "no id here at all")]
    counts = Counter(w for i, t in every if not held.get(i) for w in [*tokens(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    found = by_id(bilinear_lm.score(docs))
    for i, t in every:
        own = [*tokens(t), b"\n"]
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held.get(i, False), len(own), sum(w in counts for w in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r["score"] < 0
    assert bilinear_lm.score(no_docs).count() == 0


def test_language_model_scores_are_those_of_its_parameters(docs, monkeypatch):
    """Every token's probability by plain sums over all outcomes, which add up to 1."""
    import numpy as np

    seen = {}
    train = bilinear_lm.train

    def keep(training, model, classes, words):
        seen.update(words=words, classes=classes, model=train(training, model, classes, words))
        return seen["model"]

    monkeypatch.setattr(bilinear_lm, "train", keep)
    monkeypatch.setattr(bilinear_lm, "WORDS", 100)  # the vocabulary is small: let tokens be in buckets,
    monkeypatch.setattr(bilinear_lm, "COMMON", 150)  # and some of them unknown to tasks
    found = by_id(bilinear_lm.score(docs))
    every = [*enumerate(TEXTS), (None, "no id here at all")]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(TEXTS))}
    counts = Counter(w for i, t in every if not held.get(i) for w in [*tokens(t), b"\n"])
    words, model = seen["words"], {k: np.asarray(v, np.float64) for k, v in seen["model"].items()}
    number = {w: i for w, i in seen["classes"].items() if i < words}
    assert len(number) == 100 and len(counts) > 200 and len(seen["classes"]) < len(counts)
    class_of = lambda w: number.get(w, words + zlib.crc32(w) % bilinear_lm.BUCKETS)
    assert all(class_of(w) == i for w, i in seen["classes"].items())
    rest = {w: n for w, n in counts.items() if w not in number}
    times = Counter(rest.values())
    discount = min(max(times[1] / (times[1] + 2 * times[2]), 0.1), 0.9)
    free = discount * len(rest) / sum(rest.values())
    sums = Counter()
    for w, n in rest.items():
        sums[class_of(w)] += n - discount

    def shares(before: list[int]) -> tuple[np.ndarray, float]:
        h = sum(model["before"][c] * model["position"][j] for j, c in enumerate(before))
        own = np.exp(model["word"][:, :-1] @ h + model["word"][:, -1])
        own /= np.bincount(model["group"].astype(int), own)[model["group"].astype(int)]
        of_group = np.exp(model["groups"][:, :-1] @ h + model["groups"][:, -1])
        of_group /= of_group.sum()
        return own * of_group[model["group"].astype(int)], of_group[-1]

    def probability(w: bytes, own: np.ndarray, others: float) -> float:
        if w in number:
            return own[number[w]]
        c = class_of(w)
        return own[c] * (1 - free) * (rest[w] - discount) / sums[c] if w in rest else others * free

    end = number[b"\n"]
    for i, t in [e for e in every if len(e[1] or "") < 2000]:
        said = [*tokens(t), b"\n"]
        ids = [end] * 3 + [class_of(w) for w in said]
        total = sum(np.log10(probability(w, *shares(ids[k : k + 3][::-1]))) for k, w in enumerate(said))
        assert abs(found[i]["score"] - total) < 1e-4 * abs(total) + 1e-4, i
    own, others = shares([end, 3, words + 5])
    assert abs(sum(probability(w, own, others) for w in [*counts, b"never seen"]) - 1) < 1e-6


def test_noise_contrastive_model_learns_from_the_tokens_before(spark):
    """The third word back decides the next: neither the token before nor frequencies tell."""
    r = random.Random(5)
    texts = []
    for _ in range(3000):
        said = []
        for _ in range(10):
            k = r.randrange(4)
            said += [f"cue{k}", "and", "so", f"end{k}"]
        texts.append(" ".join(said))
    frame = spark.createDataFrame([(i, t, None, None, 1, 0.0, "") for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    rows = [x for x in bilinear_lm.score(frame).collect() if x["held_out"]]
    a_text = sum(x["score"] for x in rows) / len(rows)
    # 10 free choices of four and 30 words that follow from others: 6.0 in all at best, 12.0 without contexts of three.
    assert -9 < a_text < -6
    assert sum(x["base_score"] for x in rows) / len(rows) < -25


@pytest.mark.parametrize("copies", [1, 40])
def test_a_task_learns_from_each_token_once_however_many_it_has(monkeypatch, copies):
    import numpy as np
    import pyarrow as pa
    from types import SimpleNamespace

    seen = []
    step = bilinear_lm.Trainer.step

    def counted(trainer, ids, context):
        seen.append(len(ids))
        step(trainer, ids, context)

    monkeypatch.setattr(bilinear_lm.Trainer, "step", counted)
    monkeypatch.setattr(bilinear_lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [b"a b c a " * 4000] * copies
    model = bilinear_lm.initial(np.array([32000.0, 16000.0, 16000.0, *[0.0] * bilinear_lm.BUCKETS]) * copies)
    rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    parts = list(bilinear_lm._trained(model, {b"a": 0, b"b": 1, b"c": 2}, 3)(iter([rows])))
    assert sum(seen) == copies * 16001 == parts[0].column("weight")[0].as_py()
    assert max(seen) == bilinear_lm.BATCH


def test_log_softmax_of_far_scores():
    import numpy as np

    scores = np.array([[0, 300, 1], [5, 4, -1e4], [-200, 1, 2]], np.float32)
    at = np.array([0, 1, 2])
    plain = scores - np.log(np.exp(scores.astype(np.float64)).sum(1, keepdims=True))
    assert np.allclose(bilinear_lm._picked(scores.copy(), at), plain[np.arange(3), at] / np.log(10), rtol=1e-6)


def test_parameters_are_weighted_means_of_all_tasks(spark):
    import numpy as np

    frame = spark.createDataFrame([(i, "a b c a " * (i + 1), None, None, 1, 0.0, "") for i in range(6)], SCHEMA)
    texts = frame.selectExpr("cast(text as binary) as text").repartition(3).persist()
    counts = np.array([24.0, 12.0, 6.0, *[0.0] * bilinear_lm.BUCKETS])
    model, classes = bilinear_lm.initial(counts), {b"a": 0, b"b": 1, b"c": 2}
    parts = texts.mapInArrow(bilinear_lm._trained(model, classes, 3), bilinear_lm.PARTS).collect()
    found = bilinear_lm.train(texts, model, classes, 3)
    of_position = [x for x in parts if x["name"] == "position"]
    assert sum(x["weight"] for x in of_position) == sum(4 * (i + 1) + 1 for i in range(6))
    mean = sum(np.frombuffer(x["rows"]) for x in of_position) / sum(x["weight"] for x in of_position)
    assert np.allclose(found["position"].ravel(), mean, atol=1e-6)
    assert {k: found[k].shape for k in bilinear_lm.LEARNED} == {k: model[k].shape for k in bilinear_lm.LEARNED}


def test_long_tokens_are_tokens_like_others(spark):
    import math

    long, longer = "x" * 70, "y" * 3000
    texts = [f"{long} a {longer}"] * 30 + [f"a b{i}" for i in range(20)] + [f"{long}z c"]
    frame = spark.createDataFrame([(i, t, None, None, 1, 0.0, "") for i, t in enumerate(texts)], SCHEMA)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    counts = Counter(w for t, h in zip(texts, held) if not h for w in [*tokens(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    found = by_id(bilinear_lm.score(frame))
    for i, t in enumerate(texts):
        own = [*tokens(t), b"\n"]
        assert found[i]["n_known"] == sum(w in counts for w in own), i
        assert math.isclose(found[i]["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
    assert found[0]["score"] > found[50]["score"] and found[0]["score"] > found[0]["base_score"]
    kept = [bilinear_lm._tokens([w.encode()])[0][0] for w in (long, longer, long + "z", "a")]
    assert len(set(kept)) == 4 and kept[3] == b"a" and max(map(len, kept)) <= 33


# --- memory of tasks ---


def test_tasks_work_on_a_little_text_at_once():
    """A batch of 12 MB of text: arrays over a part of it only, and no second copy of the whole."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    r = random.Random(7)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(1500)).encode() for _ in range(1000)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, pa.array(texts)], names=["doc_id", "row_key", "source", "text"])
    model = np.zeros((len(language.HYPOTHESES), language.RUNS), np.float32)
    for work in (previous_factor._occurrences, language._judged(model)):
        tracemalloc.start()
        rows = sum(given.num_rows for given in work(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert rows >= len(texts) and peak < 120


# --- 3 ---


def measured(text: str | None) -> tuple[int, ...]:
    words, text = tokens_as_given(text), text or ""
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = {i + k for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(repeat),
    )


def tokens_as_given(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def test_host_rules_measure_whole_texts(docs, no_docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = by_id(host_rules.judge(docs))
    for i, t in enumerate(TEXTS):
        assert tuple(found[i][n] for n in names) == measured(t), i
        assert not (found[i]["base_failed"] and found[i]["kept"])
    assert len(found) == len(TEXTS) + 1
    assert host_rules.judge(no_docs).count() == 0


def host_fixture(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    mild = " ".join(f"word{i}" for i in range(40)) + " " + "#" * 15  # 5 to 10 % symbols
    gross = " ".join(f"w{i}##" for i in range(40))
    kinds = {"bad": (clean,) * 2 + (mild,) * 18, "fine": (clean,) * 19 + (gross,)}
    kinds |= {f"middle{k}": (clean, clean, mild, gross) for k in range(3)}
    rows, i = [], 0
    for host, texts in kinds.items():
        for _ in range(10):
            for t in texts * (20 // len(texts)):
                rows.append((i, t, None, host, 1, 0.0, ""))
                i += 1
    return rows + [(i, gross, None, None, 1, 0.0, "")]


def test_verdicts_follow_the_hosts_posterior(spark):
    rows = host_fixture(spark)
    found = by_id(host_rules.judge(spark.createDataFrame(rows, SCHEMA)))
    fails = {}
    for r in rows:
        n, chars, symbols, lines, repeat = measured(r[1])
        fails[r[0]] = sum(
            (a > b) + (a > 2 * b) for a, b in ((100 * symbols, 5 * chars), (10 * lines, n), (100 * repeat, 30 * n))
        ) + (n < 20) + (n < 10)
    hosts = {}
    for r in rows:
        hosts.setdefault(r[3], []).append(fails[r[0]] > 0)
    rates = [sum(x) / len(x) for x in hosts.values()]
    mean = sum(rates) / len(rates)
    spread = sum((x - mean) ** 2 for x in rates) / len(rates) - mean * (1 - mean) * sum(1 / len(x) for x in hosts.values()) / len(rates)
    strength = max(mean * (1 - mean) / max(spread, 1e-6) - 1, 1.0)
    margin = max(0.02, (mean * (1 - mean) / (strength + 1)) ** 0.5 / 2)
    allowed = {}
    for host, x in hosts.items():
        rate = (sum(x) + mean * strength) / (len(x) + strength)
        sure = 1.645 * (rate * (1 - rate) / (len(x) + strength + 1)) ** 0.5
        allowed[host] = 0 if rate - sure > mean + margin else 2 if rate + sure < mean - margin else 1
        assert all(found[r[0]]["rate"] == pytest.approx(rate) for r in rows if r[3] == host)
    assert (allowed["bad"], allowed["fine"], allowed[None]) == (0, 2, 1)
    for r in rows:
        assert found[r[0]]["n_failures"] == fails[r[0]]
        assert found[r[0]]["kept"] == (fails[r[0]] <= allowed[r[3]]), r[0]


def test_hosts_alike_are_judged_by_the_pooled_prior(spark):
    rows = [(i, t, None, f"h{i % 3}", 1, 0.0, "") for i, (_, t, *_) in enumerate(host_fixture(spark)[400:600]) for _ in (0, 1, 2)]
    rows = [(k, *r[1:3], f"h{k % 3}", *r[4:]) for k, r in enumerate(rows)]
    for r in host_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r["allowed"] == 1 and r["kept"] == (r["n_failures"] <= 1)


# --- 4 ---


def shingles(text: str | None) -> frozenset:
    w = tokens(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_are_those_of_brute_force(docs, no_docs, percent):
    sets = {i: shingles(t) for i, t in enumerate(TEXTS)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    found = by_id(path_join.near_duplicates(docs, percent))
    for i, s in sets.items():
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (len(s), find(i)), i
        assert found[i]["kept"] == (find(i) == i)
    assert (found[None]["component_id"], found[None]["kept"]) == (None, False)
    kept = path_join.one_of_each(docs, percent)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None} | {i for i in sets if find(i) == i}
    assert path_join.near_duplicates(no_docs).count() == 0


def test_wide_nodes_branch_and_lose_no_link(docs, monkeypatch):
    before = {i: r["component_id"] for i, r in by_id(path_join.near_duplicates(docs, 85)).items()}
    monkeypatch.setattr(path_join, "SMALL", 4)
    monkeypatch.setattr(path_join, "BLOCK", 2)
    monkeypatch.setattr(path_join, "DEPTH", 2)
    assert {i: r["component_id"] for i, r in by_id(path_join.near_duplicates(docs, 85)).items()} == before


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(50)] + [(90, 91), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert found == {i: 0 for i in range(51)} | {90: 90, 91: 90}


# --- 5 ---


def test_language_from_text_page_and_host(spark, no_docs):
    en = "the quick brown fox jumps over the lazy dog and then it rests "
    de = "der schnelle braune fuchs springt über den faulen hund und ruht dann "
    rows = [(i, (de if i % 2 else en) * 60, "de" if i % 2 else "en", "s", 1, 0.0, "h") for i in range(40)]
    rows += [(100, None, None, None, 1, 0.0, "h"), (101, "123 456", "en", "s", 1, 0.0, "h"), (102, "Щука плавает в реке", None, "s", 1, 0.0, "h"), (None, en, "xx", "s", 1, 0.0, "h")]
    frame = spark.createDataFrame(rows, SCHEMA)
    pages = spark.createDataFrame(
        [(1, "http://a.example.de/de/1", '<html lang="de">'), (2, None, None), (3, "no address", "x"), (4, "http://a.example.de/de/1", "")],
        "page_id long, url string, html string",
    )
    found = by_id(language.identify(frame, pages))
    for i in range(40):
        assert (found[i]["language"], found[i]["kept"]) == ("de" if i % 2 else "en", True)
    assert found[1]["host"] == "a.example.de"
    assert [found[i]["kept"] for i in (100, 101, 102, None)] == [False, False, False, True]
    kept = language.accepted(frame, pages)
    assert kept.columns == frame.columns and kept.count() == 41
    assert language.identify(no_docs, pages.limit(0)).count() == 0


def plain_runs(text: str | None) -> list[int]:
    framed = b" " + text.encode().lower() + b" " if text else b""
    letter = lambda b: chr(b).isascii() and chr(b).isalpha() or b >= 128
    plain = lambda b: letter(b) or b in b" \t\n\r\v\f"
    return [
        ((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 17
        for a, b, c in zip(framed, framed[1:], framed[2:])
        if plain(a) and plain(b) and plain(c) and (letter(a) or letter(b))
    ]


def plain_posteriors(rows: list[tuple], pages: dict[int, tuple]) -> list[tuple]:
    """(language, posterior) of each row (id, text, lang, source), by loops over everything."""
    from math import exp, log

    known, names = language.LANGUAGES, language.HYPOTHESES
    counts = {h: Counter(x for r in rows if r[2] == h for x in plain_runs(r[1])) for h in known}
    taught = {h: any(counts[h].values()) for h in known}

    def log_p(h, run):
        if h == "und":
            return -log(language.RUNS)
        if not taught[h]:
            return language.UNTAUGHT
        return log((counts[h][run] + 0.5) / (sum(counts[h].values()) + language.RUNS / 2))

    seen = []
    for i, text, _, source in rows:
        runs = plain_runs(text)
        scale = min(len(runs), language.EVIDENCE) / max(len(runs), 1)
        texts = {h: scale * sum(log_p(h, x) for x in runs) for h in names}
        host, suffix, section, markup = pages.get(i, (f"source:{source or ''}", "", "", ""))
        best = max(names, key=lambda h: texts[h])
        seen.append({"texts": texts, "best": best, "host": host, "suffix": suffix, "section": section, "markup": markup,
                     "parent": host.partition(".")[2]})
    of = lambda h, **given: sum(r["best"] == h and all(r[k] == v for k, v in given.items()) for r in seen)
    total = {h: of(h) for h in known}
    whole = {h: (total[h] + 1) / (sum(total.values()) + len(known)) for h in known}

    def shrunk(h, towards, **given):
        return (of(h, **given) + language.STRENGTH * towards) / (sum(of(x, **given) for x in known) + language.STRENGTH)

    found = []
    for r in seen:
        every = {}
        for h in known:
            prior = shrunk(h, shrunk(h, whole[h], parent=r["parent"]), host=r["host"])
            every[h] = r["texts"][h] + log((1 - language.UND) * prior)
        every["und"] = r["texts"]["und"] + log(language.UND)
        for part in ("suffix", "section", "markup"):
            if r[part]:
                given = {h: log((of(h, **{part: r[part]}) + 0.5) / (total[h] + 1)) for h in known}
                for h in known:
                    every[h] += given[h]
                every["und"] += sum(given.values()) / len(known)
        best = max(names, key=lambda h: every[h])
        found.append((best, 1 / sum(exp(x - every[best]) for x in every.values())))
    return found


def test_posteriors_are_those_of_plain_loops(spark):
    r = random.Random(8)
    words = {"en": "the and of water stone", "de": "der und von wasser stein", "fr": "le et de eau pierre", "es": "el y de agua piedra"}
    rows, addresses, pages = [], [], {}
    for i in range(60):
        lang = sorted(words)[i % 4]
        own = words[lang].split() if r.random() < 0.8 else words[r.choice(sorted(words))].split()
        text = " ".join(r.choice(own) for _ in range(r.randint(1, 12 if i % 10 else 400)))
        rows.append((i, text, lang if r.random() < 0.7 else None, r.choice(["s", "t", None])))
        if i % 3:
            host, section = f"{'ab'[i % 2]}.site{i % 3}.{r.choice([lang, 'com'])}", r.choice([lang, ""])
            markup = r.choice([lang, "", "it"])
            pages[i] = (host, host.rpartition(".")[2], section, markup)
            addresses.append((i, f"http://{host}/{section + '/' if section else ''}{i}", f'<html lang="{markup}">' if markup else ""))
    rows += [(100, "zzq xxw", None, "s"), (101, "", "en", "s"), (102, None, None, None)]
    frame = spark.createDataFrame([(i, t, g, s, 1, 0.0, "") for i, t, g, s in rows], SCHEMA).repartition(3)
    found = by_id(language.identify(frame, spark.createDataFrame(addresses, "page_id long, url string, html string")))
    for (i, text, *_), (best, posterior) in zip(rows, plain_posteriors(rows, pages)):
        assert found[i]["posterior"] == pytest.approx(posterior, abs=1e-4), i
        if posterior > 0.51:
            assert found[i]["language"] == best, i
        assert found[i]["kept"] == (bool(text) and found[i]["language"] != "und" and found[i]["posterior"] >= 0.5), i


def test_languages_of_rows_whose_labels_are_hidden(spark):
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    hidden = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    frame = given.withColumn("lang", F.when(~hidden, F.col("lang")))
    found = language.identify(frame, spark.read.parquet(f"{sf}/pages.parquet")).select("doc_id", "language", "kept")
    judged = found.join(given.where(hidden).where(F.col("lang").isin(*language.LANGUAGES)).select("doc_id", "lang"), "doc_id")
    right, n = judged.agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.count("*")).first()
    print(f"held out: {right:.4f} of {n}")
    assert n > 100 and right >= 0.95


# --- 6 ---


def test_url_rules_and_models(spark):
    urls = [
        ("http://A.org/x", "a.org", "/x", "org/", "allow"),
        ("http://www.example.org/es/1?q", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
        ("x://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
        ("http://b.com/fr/2", "b.com", "/fr/2", "com/fr/", "allow"),
        ("http://b.com/de/2", "b.com", "/de/2", "com/de/", "block"),
        ("http://c.org", "c.org", "", None, None),
        ("http://c.net/fr/9", "c.net", "/fr/9", None, "allow"),
        ("http://c.net/de/9", "c.net", "/de/9", None, "block"),
        (None, "", "", None, None), ("nothing", "", "", None, None), ("http://", "", "", None, None),
    ]
    more = [(f"http://h{i}.com/{'fr' if i % 2 else 'de'}/{i}", None, None, None, None) for i in range(60)]
    rows = [(i, u[0], "html", 1.0) for i, u in enumerate(urls + more)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, score double")
    found = {r["page_id"]: r for r in url_markov.judge(frame).collect()}
    assert len(found) == len(rows)
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule), i
        assert found[i]["verdict"] == verdict or verdict is None and found[i]["verdict"] in ("allow", "block"), i
    assert url_markov.judge(frame.limit(0)).count() == 0


def test_url_models_and_threshold_are_those_of_brute_force(spark):
    import math

    r = random.Random(6)
    hosts = ["a.com/fr/", "b.com/de/", "c.org/", "example.org/es/", "d.net/fr/", "e.net/"]
    urls = [f"http://{r.choice(hosts)}{''.join(r.choice('abc-/7') for _ in range(r.randint(1, 12)))}" for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    held = {x["page_id"]: x["held"] for x in frame.selectExpr("page_id", "pmod(xxhash64(url), 5) = 0 as held").collect()}
    found = {x["page_id"]: x for x in url_markov.judge(frame).collect()}
    symbols = ["^^^" + re.sub("[0-9]", "0", (x["host"] + x["path"]).lower()) for x in (found[i] for i in range(len(urls)))]
    kind = [dict(url_markov.RULES).get(found[i]["rule"]) for i in range(len(urls))]
    counts = {k: [Counter() for _ in range(5)] for k in ("allow", "block")}
    everything = set()
    for i, s in enumerate(symbols):
        for at in range(len(s) - 3):
            everything.add(s[at : at + 4])
            if kind[i] and not held[i]:
                for n in range(1, 5):
                    counts[kind[i]][n][s[at + 4 - n : at + 4]] += 1

    def p(k, gram):
        if len(gram) == 1:
            return (counts[k][1][gram] + 1) / (sum(counts[k][1].values()) + len(url_markov.PLAIN) + 3)
        after = [n for g, n in counts[k][len(gram)].items() if g[:-1] == gram[:-1]]
        shorter = p(k, gram[1:])
        return (counts[k][len(gram)][gram] + len(after) * shorter) / (sum(after) + len(after)) if after else shorter

    ratio = {g: math.log(p("allow", g) / p("block", g)) for g in everything}
    score = [sum(ratio[s[at : at + 4]] for at in range(len(s) - 3)) / max(1, len(s) - 3) for s in symbols]
    for i in range(len(urls)):
        assert found[i]["score"] == pytest.approx(score[i], abs=1e-9), urls[i]
    judged = [(math.floor(found[i]["score"] / url_markov.STEP), kind[i]) for i in range(len(urls)) if kind[i] and held[i]]
    total = Counter(k for _, k in judged)
    assert min(total.values()) > 5

    def error(b):
        return sum(x < b and k == "allow" for x, k in judged) / total["allow"] + 1 - sum(x < b and k == "block" for x, k in judged) / total["block"]

    least = min(error(b) for b, _ in judged)
    best = min((b for b, _ in judged if error(b) <= least + 1e-12), key=lambda b: (abs(b), b))
    best = (best + max((b + 1 for b, _ in judged if b < best), default=best)) / 2
    for i in range(len(urls)):
        if kind[i] is None:
            assert (found[i]["verdict"] == "allow") == (found[i]["score"] >= best * url_markov.STEP), urls[i]
    assert {found[i]["verdict"] for i in range(len(urls)) if kind[i] is None} == {"allow", "block"}


# --- 7 ---


def bench_words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out


def test_decontamination_is_that_of_brute_force(spark, docs, no_docs):
    items = [(1, TEXTS[7][:150]), (10, TEXTS[26][60:400].upper()), (2, "É é"), (3, None), (4, "... !"), (5, TEXTS[7][:150]), (6, "nowhere to be found")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontaminate.contamination(docs, benchmark))
    for i, t in enumerate(TEXTS):
        words, hit, named = bench_words(t), set(), set()
        for item, text in items:
            w = bench_words(text)
            n = min(13, len(w))
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    named.add(str(item))
        r = found[i]
        assert (r["n_words"], r["n_hit"], r["items"]) == (len(words), len(hit), sorted(named)), i
    assert decontaminate.clean_documents(docs, benchmark).columns == docs.columns
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("n_hit > 0").isEmpty()
    assert decontaminate.contamination(no_docs, benchmark).count() == 0


def test_letters_that_fold_by_context_are_compared_as_they_are(spark):
    texts = [
        "ΟΔΟΣ.Α one two three four five six seven eight nine ten eleven",
        "\u0130STANBUL a b c d e f g h i j k l m", "\u212Aelvin n o p q r s t u v w x y", "kelvin N o p q r s t u v w x y",
    ]
    frame = spark.createDataFrame([(i, t, None, None, 1, 0.0, "") for i, t in enumerate(texts)], SCHEMA)
    for k, t in enumerate(texts[:4]):
        found = by_id(decontaminate.contamination(frame, spark.createDataFrame([(9, t)], "item_id long, text string")))
        for i in found:
            assert (found[i]["n_hit"], found[i]["items"]) == ((len(bench_words(t)), ["9"]) if i == k else (0, [])), (k, i)


# --- 8 ---


def test_mix_meets_its_budgets(docs, no_docs):
    rows = mix.mix(docs).collect()
    sources: dict = {}
    for r in rows:
        assert r["size"] == (len(tokens(TEXTS[r["doc_id"]])) if r["doc_id"] is not None else 5)
        assert 0 <= r["taken"] <= 3 * r["size"]
        sources.setdefault(r["source"], []).append(r)
    order = sorted((s for s in sources if s is not None)) + [None]
    size = {s: sum(r["size"] for r in sources[s]) for s in order}
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    goal, open_, rest = {}, set(order), float(sum(size.values()))
    while True:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 3 * size[s]}
        if not full:
            break
        for s in full:
            goal[s] = 3 * size[s]
            rest -= goal[s]
        open_ -= full
    goal |= {s: weight[s] * level for s in open_}
    for s in order:
        assert {r["source_size"] for r in sources[s]} == {size[s]}
        assert sources[s][0]["target"] == pytest.approx(goal[s])
        assert sum(r["taken"] for r in sources[s]) == int(sources[s][0]["target"])
    again = sorted((str(r["doc_id"]), r["taken"]) for r in mix.mix(docs.repartition(5)).collect())
    assert again == sorted((str(r["doc_id"]), r["taken"]) for r in rows)
    assert mix.mix(no_docs).count() == 0


# --- 9 ---


def without_earlier(rows: list[tuple[int, str | None]], length: int = 100) -> dict:
    seen: set[bytes] = set()
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("many", [2048, 2])
def test_repeats_are_those_of_brute_force(docs, no_docs, monkeypatch, many):
    monkeypatch.setattr(previous_factor, "MANY", many)
    expected = without_earlier(list(enumerate(TEXTS)))
    found = by_id(previous_factor.remove_repeats(docs))
    for i, e in expected.items():
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == e, i
    rest = previous_factor.without_repeats(docs)
    assert rest.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in rest.collect()}
    for i, (_, removed, _, kept) in expected.items():
        if removed and not kept.split():
            assert i not in left
        elif removed:
            assert left[i] == kept.decode("utf-8", "ignore")
        else:
            assert left[i] == TEXTS[i]
    assert previous_factor.remove_repeats(no_docs).count() == 0


def test_passages_are_found_across_chunks_tasks_and_partitions(docs):
    texts = [t.encode() for t in TEXTS if t]
    whole = previous_factor.anchors(texts)
    alone = [previous_factor.anchors([t]) for t in texts]
    for column in ("anchor", "context", "start", "span"):
        assert whole[column].tolist() == [x for a in alone for x in a[column].tolist()]
    rows = lambda frame: sorted(tuple(map(str, r)) for r in frame.collect())
    assert rows(previous_factor.remove_repeats(docs.coalesce(1))) == rows(previous_factor.remove_repeats(docs.repartition(8, "doc_id")))


def test_previous_factors_are_those_of_brute_force():
    import numpy as np

    r = random.Random(5)
    for _ in range(20):
        base = bytes(r.choice(b"ab") for _ in range(400))
        spans = [r.randint(0, 60) for _ in range(r.randint(1, 5))]
        contexts = [base[s : s + span + 100] for s, span in zip(r.choices(range(200), k=len(spans)), spans)]
        text = b"".join(contexts)
        begins = [sum(map(len, contexts[:i])) for i in range(len(contexts))]
        windows = [b + k for b, span in zip(begins, spans) for k in range(span + 1)]

        def common(a, b):
            return next((k for k in range(100) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), 100)

        expected = [max((common(w, e) for e in windows[:i]), default=0) for i, w in enumerate(windows)]
        assert np.concatenate(previous_factor.previous_factors(contexts, np.array(spans))).tolist() == expected


# --- 10 ---


def test_token_counts_are_the_librarys_and_are_encoded_once(spark, docs, no_docs, tmp_path):
    library = Tokenizer.from_file(TOKENIZER)
    cache = f"{tmp_path}/cache"
    found = by_id(token_cache.count_tokens(docs, TOKENIZER, cache))
    for i, t in enumerate(TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (found[i]["n_bytes"], found[i]["n_tokens"]) == (len((t or "").encode()), n), i
    distinct = len({t or "" for t in TEXTS}) + 1
    assert spark.read.parquet(cache).count() == distinct
    assert by_id(token_cache.count_tokens(docs, TOKENIZER, cache)) == found
    assert spark.read.parquet(cache).count() == distinct
    assert token_cache.count_tokens(no_docs, TOKENIZER, f"{tmp_path}/none").count() == 0


LIBRARY = Tokenizer.from_file(TOKENIZER)
def test_cache_of_the_setting_lasts_and_common_texts_get_their_counts(spark, docs, tmp_path, monkeypatch):
    extra = spark.createDataFrame([(i % 300 + 1000 if i % 4 else None, "hot hot text") for i in range(400)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    plain = {(i, t or "") for i, t in rows.collect()}
    library = Tokenizer.from_file(TOKENIZER)
    expected = sorted((str(r["doc_id"]), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows.collect())
    assert len(plain) > len(TEXTS)
    spark.conf.set(token_cache.CACHE_SETTING, f"{tmp_path}/lasting")
    try:
        for common in (1000, 3, 1):  # all, some, few digests are common
            monkeypatch.setattr(token_cache, "COMMON", common)
            found = token_cache.count_tokens(rows, TOKENIZER).collect()
            assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in found) == expected
            n_stored = spark.read.parquet(f"{tmp_path}/lasting").count()
            assert n_stored == len({t for _, t in plain})
        # What is stored is used: a count changed there comes back.
        digest = hashlib.sha256(b"hot hot text").digest()
        key = token_cache.tokenizer_digest(TOKENIZER)
        spark.createDataFrame([(digest, 99, key)], token_cache.CACHE_SCHEMA).write.mode("append").parquet(f"{tmp_path}/lasting")
        found = token_cache.count_tokens(rows, TOKENIZER).where("doc_id >= 1000").collect()
        assert {r["n_tokens"] for r in found} == {99}
    finally:
        spark.conf.unset(token_cache.CACHE_SETTING)


COUNT = token_cache._counter(TOKENIZER)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé1 \n\t\u00a0!<|>endoftx", max_size=30), max_size=5))
def test_pieces_count_as_whole_texts(texts):
    assert COUNT(texts) == [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in texts]


def test_sentencepiece_counts(docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = by_id(token_cache.count_tokens(docs.limit(20), path))
    for i, r in found.items():
        if i is not None:
            assert r["n_tokens"] == len(model.encode(TEXTS[i] or ""))


# --- every stage ---


def test_stages_keep_columns_of_any_name_and_treat_repeated_rows_alike(spark):
    odd = ["row_key", "own_key", "found_id", "found_key", "kept_bytes", "_kept", "_key", "text_key", "_right_id", "_right_key",
           "kept", "language", "host", "node", "class", "component_id", "items", "a.b", "size", "word"]
    en = "the quick brown fox jumps over the lazy dog and then it rests under a tree near the river "
    texts = [en * 3, en * 3, "another text that the others do not hold at all in any way " * 2, en * 3, None, ""]
    rows = [(i, t, "en", "s", 1, *[f"{c}{i}" for c in odd]) for i, t in enumerate(texts)]
    rows += [rows[2], rows[0], (2, "the same id with another text here and now and then " * 3, "en", "s", 1, *["x"] * len(odd))]
    names = ["doc_id", "text", "lang", "source", "n_chars", *odd]
    docs = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n in ('doc_id', 'n_chars') else 'string'}" for n in names))
    pages = spark.createDataFrame([(1, "http://a.en/en/1", '<html lang="en">')], "page_id long, url string, html string")
    benchmark = spark.createDataFrame([(1, texts[2])], "item_id long, text string")
    out = {
        "accepted": language.accepted(docs, pages),
        "one_of_each": path_join.one_of_each(docs, 80),
        "without_repeats": previous_factor.without_repeats(docs),
        "clean": decontaminate.clean_documents(docs, benchmark),
    }
    for name, frame in out.items():
        assert frame.columns == names, name
        for r in frame.collect():
            if r["a.b"] != "x":
                assert [r[c] for c in odd] == [f"{c}{r['doc_id']}" for c in odd], name
    ids = {name: sorted(r["doc_id"] for r in frame.collect()) for name, frame in out.items()}
    assert ids["accepted"] == [0, 0, 1, 2, 2, 2, 3]
    assert ids["one_of_each"] == [0, 0, 2, 2, 2, 4, 5]
    assert ids["without_repeats"] == [0, 0, 2, 2, 2, 4, 5]
    assert ids["clean"] == [0, 0, 1, 2, 3, 4, 5]
    assert sorted(r["doc_id"] for r in mix.mix(docs).collect()) == [0, 0, 1, 2, 2, 2, 3, 4, 5]
    for frame in (host_rules.judge(docs), token_cache.count_tokens(docs, TOKENIZER), bilinear_lm.score(docs),
                  quality_vote.score(docs, spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int"))):
        assert sorted(r["doc_id"] for r in frame.collect()) == [0, 0, 1, 2, 2, 2, 3, 4, 5]
