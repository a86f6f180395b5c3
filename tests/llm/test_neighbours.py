import numpy as np
from pyspark.sql import functions as F

from terroir.llm import neighbours
from terroir.llm.neighbours import hilbert_keys, nearest


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(i, np.array(v, np.float64))
    ids = np.array(sorted(good))
    out = {}
    if not len(ids):
        return out
    m = np.stack([good[i] for i in ids])
    for i in ids[ids % 50 == 0]:
        scores = neighbours.cosines(np.tile(good[i], (len(m), 1)), m)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def _search(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {}
    for r in sorted(nearest(frame, lambda i: i % 50 == 0, **more).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_hilbert_curve_is_one_path():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 32)) * 0.5
    rows = [(i, (centres[i % 20] + rng.normal(size=32)).astype(np.float32).tolist()) for i in range(3000)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    want, got = brute(rows), _search(spark, rows, block=64)
    assert set(got) == set(want)
    hits = sum(len({x for x, _ in want[q]} & {x for x, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = dict(rows)
    for q, found in got.items():
        for v, score in found:
            assert score == neighbours.cosines(np.array([exact[q]]), np.array([exact[v]]))[0]


def test_copies_and_ties(spark):
    # A third of all rows are one vector; ties go to the smaller id and copies hide nothing.
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(np.float32(x)) for x in rng.normal(size=3)]) for i in range(900)]
    want, got = brute(rows), _search(spark, rows)
    assert {q: [v for v, _ in f] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, None), (100, []), (150, [0.0, 0.0]), (200, [1.0, None]), (250, [nan, 1.0]), (300, [inf, 1.0]), (350, [1.0, 2.0, 3.0]),
            (None, [1.0, 1.0]), (400, [1.0, 1.0]), (400, [1.0, 1.0]), (401, [-1.0, 0.5])]
    got = _search(spark, rows)
    assert {q: [v for v, _ in f] for q, f in got.items()} == {0: [400, 401], 400: [0, 401]}
    assert _search(spark, []) == {} and _search(spark, [(0, [1.0])]) == {}
    extra = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "v", "rep", "score", "rank", "curve", "block", "key")})
    assert nearest(extra, lambda i: i % 50 == 0).count() == 4
