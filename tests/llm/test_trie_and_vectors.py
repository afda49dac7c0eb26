"""The prefix trie and the two vector searches against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import connect, difference

from kerbstone.llm import bit_codes, cover_tree, prefix_trie, queries, vectors

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_cover_tree"])
def test_queries_match_their_sql(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR)
    assert difference(rows, connect(SF_DIR).sql(queries.ORACLE_SQL[name])) is None


# --- 11 ---


def conversations(r: random.Random) -> list[tuple]:
    """conv_id, turn, role, text: shared beginnings, a long one, gaps, NULLs, empty texts."""
    lines = ["", None, "one", "two words", "  three\tmore words ", "x" * 5000, "Ü é"]
    rows = []
    for c in [*range(0, 90), 100, 101, 103, 119, 140, 70000, 70001, 200000]:
        n = 60 if c in (20, 27) else r.choice([0, 1, 2, 3, 8, 9, 16, 17])
        rows += [(c, t if t else None, r.choice(["user", None]) if t % 2 else "user", lines[2] if t < 5 else r.choice(lines)) for t in range(n)]
    rows += [(None, 1, "user", "nobody"), (-19, 1, "user", "one"), (-20, 1, "user", "one")]
    r.shuffle(rows)
    return rows


def expected_trie(rows: list[tuple]) -> list[tuple]:
    said: dict = {}
    for c, t, role, text in rows:
        if c is not None:
            said.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [turn[2:] for turn in sorted(turns, key=lambda x: x[:2])] for c, turns in said.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = own.get(first, [])[:h] + turns[h:]
    members: dict = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    below, out = {}, []
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        words = len(node[-1][1].encode().split()) if node else 0
        below[node] = (
            sum(below[k][0] for k in kids) if kids else 1,
            (len(members[node]) - 1) * words + sum(below[k][1] for k in kids),
        )
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids),
            *below[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


SAID = "conv_id long, turn long, role string, text string, digest string, words string, place string"


def found_trie(frame) -> list[tuple]:
    nodes = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered_turns(frame)))
    return sorted((tuple(r)[:8] for r in nodes.collect()), key=str)


@pytest.mark.parametrize("run", [1 << 16, 2])
def test_trie_is_that_of_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    rows = conversations(random.Random(11))
    frame = spark.createDataFrame([(*r, "d", "w", "p") for r in rows], SAID).repartition(5)
    found = found_trie(frame)
    assert found == expected_trie(rows)
    assert max(r[1] for r in found) > 3 * prefix_trie.BLOCK


def test_repeated_turns_stay_and_an_empty_table_has_no_trie(spark):
    rows = [(0, 1, "user", "a b")] * 6 + [(40, 1, "user", "a b")] * 6
    frame = spark.createDataFrame([(*r, "", "", "") for r in rows], SAID)
    assert found_trie(frame) == expected_trie(rows)
    assert found_trie(frame.limit(0)) == []


# --- 12 and 13 ---


def vector_rows(r: np.random.Generator) -> list[tuple]:
    """vec_id, embedding, label: a tight cluster, equal vectors, others; and rows that take no part."""
    loose = r.standard_normal((400, 16))
    tight = r.standard_normal(16) + 0.05 * r.standard_normal((300, 16))
    equal = np.repeat(r.standard_normal((1, 16)), 40, 0)
    every = np.concatenate((loose, tight, equal))
    r.shuffle(every)
    every /= np.sqrt((every**2).sum(1))[:, None]
    rows = [(i, x.astype(np.float32).tolist(), int(r.integers(3))) for i, x in enumerate(every)]
    nan, inf, some = float("nan"), float("inf"), rows[5][1]
    rows += [(800, None, 1), (900, some[:-1] + [None], 1), (1000, some[:-1] + [nan], 1), (1100, some[:-1] + [-inf], 1), (None, some, 1)]
    rows += [(1200, [0.0] * 16, 1), (1300, [], 1), (1400, some[:4], 1), rows[0], rows[100]]
    return rows


ROWS = vector_rows(np.random.default_rng(12))
NO_LABEL = (1500, ROWS[7][1], None)
VECTORS = "vec_id long, embedding array<float>, label int, shard string, query int, positives string, code string"


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.createDataFrame([(*r, "s", 1, "p", "c") for r in [*ROWS, NO_LABEL]], VECTORS).repartition(4)


def usable(rows: list[tuple]) -> dict[int, tuple[np.ndarray, int]]:
    fine = {}
    for i, x, label in rows:
        if i is not None and x is not None and None not in x and np.isfinite(x).all():
            fine[i] = (np.array(x + [0.0] * (16 - len(x)), np.float32).astype(float), label)
    return fine


@pytest.mark.parametrize("shard", [4096, 100])
def test_hard_negatives_are_those_of_brute_force(embeddings, monkeypatch, shard):
    monkeypatch.setattr(cover_tree, "SHARD", shard)
    given = {i: (np.floor(256 * x), (y + 1) % 10 if i % 7 == 0 else y) for i, (x, y) in usable(ROWS).items()}
    expected = []
    for a, (vector, label) in given.items():
        if a % 100 == 0:
            order = sorted((-int(x @ vector), i) for i, (x, _) in given.items() if i != a)
            for minus, p in [(s, i) for s, i in order if given[i][1] == label][:5]:
                other = [(-s, i) for s, i in order if given[i][1] != label and 80 * -minus <= 100 * -s <= 100 * -minus]
                expected += [(a, p, k + 1, i, -minus, s) for k, (s, i) in enumerate(other[:5])]
    found = cover_tree.hard_negatives(cover_tree.candidates(embeddings)).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_cover_trees_cover_and_skip():
    r = np.random.default_rng(3)
    points = np.floor(256 * np.concatenate([c + 0.02 * r.standard_normal((200, 8)) for c in r.standard_normal((12, 8))]))
    tree = cover_tree.CoverTree(np.arange(len(points)), np.zeros(len(points)), points)
    assert len(tree.nodes) > 12 and not any(n.rows is not None and n.children for n in tree.nodes)
    assert np.array_equal(np.sort(np.concatenate([n.rows for n in tree.nodes if n.rows is not None])), np.arange(len(points)))

    def under(number):
        node = tree.nodes[number]
        return node.rows if node.rows is not None else np.concatenate([under(c) for c in node.children])

    for number, node in enumerate(tree.nodes):
        assert tree._distances(under(number), node.centre).max() <= tree.radii[number]
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return super().__getitem__(at)

    tree.vectors = points.view(Counted)
    ((rows, scores),) = tree.best(points[5], np.ones(len(points), bool), np.array([-np.inf]), np.array([np.inf]), 5)
    exact = points @ points[5]
    assert np.asarray(rows).tolist() == np.lexsort((np.arange(len(points)), -exact))[:5].tolist()
    assert sum(seen) < len(points) / 3  # the other clusters are skipped


def test_nearest_have_exact_scores_and_full_recall_here(embeddings, monkeypatch):
    given = {i: x for i, (x, _) in usable([*ROWS, NO_LABEL]).items() if x.any()}
    for shard in (16384, 100):
        monkeypatch.setattr(bit_codes, "SHARD", shard)
        found: dict = {}
        for r in bit_codes.nearest(bit_codes.participants(embeddings)).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert set(found) == {i for i in given if i % 20 == 0}
        hits = 0
        for q, got in found.items():
            got.sort()
            assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
            assert all(s == pytest.approx(given[i] @ given[q], abs=1e-12) for _, i, s in got)
            assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
            exact = sorted(((given[i] @ given[q] for i in given if i != q)), reverse=True)
            hits += sum(s >= exact[19] - 1e-12 for _, _, s in got)
        assert hits / (20 * len(found)) >= 0.97


def test_recall_over_a_driver_table(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in frame.collect()}
    ids = np.array(sorted(rows))
    every = np.array([rows[i] for i in ids])
    found: dict = {}
    for r in bit_codes.nearest(bit_codes.participants(frame)).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = np.where(ids == q, -np.inf, every @ rows[q])
        hits += len(found[q] & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits / (20 * len(found)) >= 0.97


def test_estimates_are_off_as_far_as_they_say():
    r = np.random.default_rng(4)
    points, queries_ = r.standard_normal((3000, 32)), r.standard_normal((20, 32))
    turn = bit_codes.rotation(32)
    assert np.allclose(turn @ turn.T, np.eye(32))
    code, length, aligned = bit_codes.encode(points, np.zeros(32), turn)
    signs = np.unpackbits(code, axis=1)[:, : turn.shape[1]] * 2.0 - 1
    estimate = (queries_ @ turn) @ signs.T * length / (aligned * np.sqrt(turn.shape[1]))
    off = length * np.sqrt(1 - aligned**2) / aligned / np.sqrt(turn.shape[1] - 1) * np.sqrt((queries_**2).sum(1))[:, None]
    error = (estimate - queries_ @ points.T) / off
    assert abs(error.mean()) < 0.02 and (np.abs(error) > bit_codes.SURE).mean() < 0.025


def test_empty_and_small_tables_of_vectors(spark, embeddings):
    none = embeddings.limit(0)
    assert cover_tree.hard_negatives(cover_tree.candidates(none)).count() == 0
    assert bit_codes.nearest(bit_codes.participants(none)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (7, [1.0, 1.0], 2)], "vec_id long, embedding array<float>, label int")
    found = sorted(map(tuple, bit_codes.nearest(bit_codes.participants(few)).collect()))
    assert found == [(0, 1, 7, 1.0), (0, 2, 20, 0.5), (20, 1, 7, 1.0), (20, 2, 0, 0.5)]


def test_only_numbers_count(spark):
    rows = [([1.0, 2.0],), ([1.0, None],), ([float("nan")],), ([float("-inf")],), (None,), ([],)]
    frame = spark.createDataFrame(rows, "x array<double>")
    assert [r[0] for r in frame.select(vectors.finite("x")).collect()] == [True, False, False, False, False, True]
