"""The blocked n-gram join against all pairs, with the awkward rows, and with families of many blocks."""

import random

import numpy as np
import pytest
from llm_rows import edge_docs, empty_docs, rows, words
from test_llm_pairs_and_files import PAD, groups_brute, mutated, shingle_sets

from sievelake.llm import ngram_join


def check(spark, more, shingle, percent):
    table = rows() + more
    out = [tuple(r) for r in ngram_join.join(edge_docs(spark, more), shingle, percent).collect()]
    sets, want = shingle_sets(table, shingle), groups_brute(table, shingle, *percent)
    assert len(out) == len(table)
    for doc_id, n, component in out:
        assert n in {len(s) for s in sets[doc_id]}
        if doc_id is not None:
            assert component == want[doc_id], doc_id
    assert {(n, c) for d, n, c in out if d is None} == {(0, None), (len(sets[2][0]), 2)}
    return want


@pytest.mark.parametrize("shingle,percent", [(4, (85, 100)), (5, (80, 100))])
def test_components_are_those_of_all_pairs(spark, shingle, percent):
    rng = random.Random(shingle)
    more = []
    for family in range(12):
        ws = words(rng, rng.randint(6, 150))
        more += [(1000 + 100 * family + i, mutated(rng, ws, rng.choice([0, 0.005, 0.01, 0.02, 0.04])), *PAD) for i in range(8)]
    short = words(rng, 12)
    more += [(3000 + i, " ".join(short[: i % 12 + 1]), *PAD) for i in range(30)]
    check(spark, more, shingle, percent)


def test_large_families_in_many_blocks(spark, monkeypatch):
    """One family of three clusters that share a passage, chains of drifting texts among them, in blocks of ten rows."""
    for name, value in (("ROWS", 10), ("ENTRIES", 4000), ("HUBS", 3), ("CHUNK", 64)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(8)
    passage, more = words(rng, 90), []
    for cluster in range(3):
        ws = words(rng, 8) + passage
        more += [(1000 * (cluster + 1) + i, mutated(rng, ws, rng.choice([0.005, 0.02, 0.05])), *PAD) for i in range(70)]
    ws = passage + words(rng, 60)
    for i in range(40):  # each like its neighbours, the ends unlike
        ws = ws[2:] + words(rng, 2)
        more.append((9000 + i, " ".join(ws), *PAD))
    want = check(spark, more, 4, (85, 100))
    assert len({want[9000 + i] for i in range(40)}) == 1


def test_blocks_of_a_family_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROWS", 10)
    rng = random.Random(9)
    ws = words(rng, 100)
    more = [(i, mutated(rng, ws, 0.01), *PAD) for i in range(1000, 1300)]
    seen = []
    monkeypatch.setattr(ngram_join, "keep", lambda df, f=ngram_join.keep: seen.append(df) or f(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ngram_join.join(edge_docs(spark, more), 4, (85, 100)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen if df.columns == ["a", "b"]]
    assert all("hashpartitioning(family" in p and "CartesianProduct" not in p and "NestedLoop" not in p for p in plans if "MapInArrow" in p)
    assert any("REPARTITION_BY_COL" in p for p in plans)


def test_linked_is_the_plain_comparison():
    rng = np.random.default_rng(4)
    universe = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = []
    for _ in range(60):
        base = universe[: rng.integers(1, 300)]
        sets.append(np.unique(base[rng.random(len(base)) > rng.choice([0, 0.02, 0.1])] if len(base) > 1 else base))
    sets = [s if len(s) else universe[:1] for s in sets]
    got = ngram_join.linked(sets[:25], sets[25:], 85, 100)
    for i, a in enumerate(sets[:25]):
        for j, b in enumerate(sets[25:]):
            common = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * common >= 85 * (len(a) + len(b) - common))


def test_connections_join_what_a_matrix_links():
    links = np.array([[1, 0, 0], [1, 1, 0], [0, 0, 0], [0, 0, 1]], bool)
    pairs = ngram_join.connections(links, np.array([5, 6, 7, 8]), np.array([9, 4, 8]))
    assert pairs == [(4, 5), (4, 6), (4, 9)]


def test_join_of_no_rows(spark):
    assert ngram_join.join(empty_docs(spark)).count() == 0
