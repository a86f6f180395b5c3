import random
from collections import Counter, defaultdict

import numpy as np
from llm_words import lowered
from pyspark.sql import functions as F

from terroir.llm import near_duplicates as near
from terroir.llm.common import components


def brute(rows, k, percent):
    """Component by id from all pairs that share a shingle."""
    sets = defaultdict(set)
    for i, text in rows:
        w = lowered(text)
        sets[i] |= {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def _edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([4, 20, 80, 200]))]
        for _ in range(rng.choice([1, 3, 40])):
            rows.append((len(rows) * 3 + 1, _edited(rng, base, rng.randrange(1 + len(base) // 12))))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 85), (5, 80)):
        want, sizes = brute(rows, k, percent)
        got = near.near_duplicates(docs, k, percent).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
        kept = {r["doc_id"] for r in near.drop_near_duplicates(docs, k, percent).collect()}
        assert kept == set(want.values())


def test_links_that_the_pivot_misses(spark):
    # Chains: each text differs from the next by one edit more, so only neighbours are linked.
    rng, rows = random.Random(6), []
    for chain in range(5):
        words = [f"c{chain}w{j}" for j in range(120)]
        for step in range(25):
            rows.append((rng.randrange(10**9), " ".join(words)))
            words[rng.randrange(120)] = f"c{chain}s{step}"
            words[rng.randrange(120)] = f"c{chain}t{step}"
    want, _ = brute(rows, 3, 85)
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_large_group_makes_few_rows(spark):
    # 2000 near copies, many of them too far from the rest: no step may hold a row per pair.
    rng = random.Random(7)
    base = [f"w{j}" for j in range(60)]
    rows = [(i, _edited(rng, base, rng.randrange(5))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows, 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs, 3, 85).collect()}
    assert sum(got[i] != want[i] for i in want) == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(8)
    seeds = near.round_seeds(120)
    for n in (1, 2, 7, 40, 3000):
        one = rng.integers(1, 2**63, n, dtype=np.uint64)
        assert (near.sketch(one, 120, seeds) < 2**64 - 1).all()
    shared = rng.integers(1, 2**63, 900, dtype=np.uint64)
    a, b = (np.append(shared, rng.integers(1, 2**63, 50, dtype=np.uint64)) for _ in range(2))
    assert abs((near.sketch(a, 120, seeds) == near.sketch(b, 120, seeds)).mean() - 0.9) < 0.1


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + k, 1001 + k) for k in range(70)] + [(5, 2000 + k) for k in range(500)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_odd_documents(odd_docs, no_docs, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] is not None]
    want, sizes = brute(rows, 3, 85)
    for docs in (odd_docs, clashing):
        got = near.near_duplicates(docs, 3, 85).collect()
        assert len(got) == 13
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] == sizes[r["doc_id"]]
        kept = near.drop_near_duplicates(docs, 3, 85)
        assert kept.columns == docs.columns
        ids = [r["doc_id"] for r in kept.collect()]
        assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 2
    assert near.near_duplicates(no_docs).count() == 0 and near.drop_near_duplicates(no_docs).count() == 0
    assert odd_docs.where(F.col("doc_id") == 5).count() == 2
