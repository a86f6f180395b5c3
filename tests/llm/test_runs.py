import hashlib
import random
import zlib

import numpy as np
import pytest

from terroir.llm import queries, runs


def brute_runs(w, min_length=6, min_exponent=4):
    """Every maximal stretch of period q whose smallest period is q, by definition."""
    n, out = len(w), set()
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            seg = w[s:e]
            smallest = next(p for p in range(1, len(seg) + 1) if all(seg[k] == seg[k + p] for k in range(len(seg) - p)))
            if smallest == q and e - s >= max(min_length, min_exponent * q):
                out.add((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def expected(doc_id, text):
    w = planted(text.split() if text else [], doc_id)
    found = brute_runs(w)
    drop = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(w), len(found), best[0], best[1], best[2], None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in drop).encode()).hexdigest())


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [[rng.choice("ab" if k % 3 else "abc") for _ in range(rng.randrange(0, 60))] for k in range(300)]
    texts += [list("ab" * 20), list("a" * 30), ["x"] * 5, list("abaababaab" * 3)]
    ids = []
    vocab = {}
    for t in texts:
        ids += [vocab.setdefault(x, len(vocab)) for x in t]
    n = np.array([len(t) for t in texts])
    d, start, length, q = runs.runs_of(np.array(ids, np.int64), n)
    got = {}
    for k in range(len(d)):
        got.setdefault(int(d[k]), []).append((int(start[k]), int(length[k]), int(q[k])))
    for k, t in enumerate(texts):
        assert got.get(k, []) == brute_runs(t), (k, "".join(t))


def test_query_equals_brute_force(spark, sf):
    got = {r.doc_id: tuple(r[c] for c in ("doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))
           for r in queries.op11_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted_docs = 0
    for r in docs:
        want = expected(r.doc_id, r.text)
        planted_docs += want[2] > 0
        assert got[r.doc_id] == want, r.doc_id
    assert planted_docs > 5


def test_odd_rows(spark, odd_docs, clashing, no_docs):
    got = runs.find_runs(odd_docs, seed=runs.contract_seed()).collect()
    assert len(got) == odd_docs.count()
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[(1, 0)].runs == [] and by[(1, 0)].collapsed == ""
    eight = next(r for r in got if r.doc_id == 8)
    assert [tuple(x) for x in eight.runs] == [(eight.n_words - 7, 7, 1)] and eight.collapsed.endswith("x A")
    assert runs.find_runs(clashing).count() == clashing.count()
    assert runs.find_runs(no_docs).count() == 0


def test_long_periodic_text(spark):
    text = " ".join(["u", "v", "w"] * 30_000 + ["end"])
    got = runs.find_runs(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).collect()
    for r in got:
        assert [tuple(x) for x in r.runs] == [(0, 90_000, 3)] and r.collapsed == "u v w end"
