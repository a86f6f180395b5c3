import hashlib
from collections import defaultdict

import pytest
from llm_words import words

from terroir.llm import mixing
from terroir.llm.common import word_count


def targets(sizes, weights=(1, 2, 3), epochs=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    goal, left, open_ = {s: 0.0 for s in order}, float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total, share, left = sum(weight[s] for s in open_), left, 0.0
        for s in sorted(open_, key=order.index):
            goal[s] += share * weight[s] / total
        for s in list(open_):
            if goal[s] >= epochs * sizes[s]:
                left += goal[s] - epochs * sizes[s]
                goal[s] = float(epochs * sizes[s])
                open_.discard(s)
    return goal


def taken(rows, goal, epochs=3):
    """Words taken per row by walking each source's queue copy by copy."""
    queues = defaultdict(list)
    for doc, source, size in rows:
        queues[source].append((hashlib.md5(str("null" if doc is None else doc).encode()).hexdigest(), doc is None, doc or 0, size, doc))
    out = defaultdict(list)
    for source, queue in queues.items():
        queue.sort(key=lambda x: x[:4])
        got, used = [0] * len(queue), 0
        for _ in range(epochs):
            for k, x in enumerate(queue):
                part = max(0, min(x[3], int(goal[source]) - used))
                got[k] += part
                used += x[3]
        for x, n in zip(queue, got, strict=True):
            out[x[4]].append(n)
    return {d: sorted(v) for d, v in out.items()}


def test_equals_walk(spark):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", (i * 37) % 400 if i % 11 else 9000) for i in range(600)] + [(700 + i, None, 3) for i in range(5)] + [(710, "tiny", 1), (711, "zero", 0)]
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    goal = targets(sizes)
    got = mixing.fair_queues(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    assert len(got) == len(rows)
    want = taken(rows, goal)
    for r in got:
        assert r["target"] == pytest.approx(goal[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == want[r["doc_id"]][0] <= 3 * r["size"]
    per = defaultdict(int)
    for r in got:
        per[r["source"]] += r["taken"]
    assert all(abs(per[s] - goal[s]) < 1 for s in goal)
    again = mixing.fair_queues(spark.createDataFrame(rows[::-1], "doc_id long, source string, size long").repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mix_equals_queues(spark):
    rows = [(i, " ".join(f"w{j}" for j in range((i * 13) % 50)), "en", f"s{i % 4}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    whole = {r[0]: r[1].split() for r in rows}
    for r in out.collect():
        assert r["text"].split() == whole[r["doc_id"]][: len(r["text"].split())]
        got[r["doc_id"]] += len(words(r["text"]))
    queues = mixing.fair_queues(docs.select("doc_id", "source", word_count("text").alias("size"))).collect()
    assert {r["doc_id"]: r["taken"] for r in queues if r["taken"]} == dict(got)


def test_mix_queues_every_row(spark):
    # Null ids, and ids that repeat with another text, another source, or alike in everything; the first null row has no words.
    rows = [(None, "", "en", "s0", 0)] + [(None, " ".join(f"n{i}x{j}" for j in range(10 + i)), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(i % 20, " ".join(f"d{i}x{j}" for j in range(30 + i)), "en", f"s{i % 4}", 0) for i in range(60)] + [(7, "alike in all", "en", "s1", 0)] * 9
    rows += [(8, "same text", lang, source, n) for lang in ("en", "fr") for source in ("s0", None) for n in (1, 2)]
    sized = [(r[0], r[3], len(words(r[1]))) for r in rows]
    sizes = defaultdict(int)
    for _, source, n in sized:
        sizes[source] += n
    goal = targets(sizes)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(docs).collect()
    per_id, per_source = defaultdict(int), defaultdict(int)
    for r in got:
        per_id[r["doc_id"]] += len(words(r["text"]))
        per_source[r["source"]] += len(words(r["text"]))
    assert dict(per_id) == {d: sum(n) for d, n in taken(sized, goal).items() if sum(n)}
    assert all(abs(per_source[s] - goal[s]) < 1 + 1e-6 for s in goal)
    again = mixing.mix(spark.createDataFrame(rows[::-1], docs.schema).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_odd_documents(odd_docs, no_docs, clashing):
    for docs in (odd_docs, clashing):
        sized = docs.select("doc_id", "source", word_count("text").alias("size"))
        rows = mixing.fair_queues(sized).collect()
        assert len(rows) == 13 and {len(words(r["text"])) for r in docs.collect()} == {r["size"] for r in rows}
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
        assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() > 0
    assert mixing.fair_queues(no_docs.selectExpr("doc_id", "source", "n_chars AS size")).count() == 0 and mixing.mix(no_docs).count() == 0
