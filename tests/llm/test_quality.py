import random
import re
from collections import Counter

from llm_words import words

from terroir.llm import quality


def measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = Counter(zip(w, w[1:], w[2:]))
    marked = {j for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(x) for x in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(marked), "n_lines": len(lines), "n_upper": sum("A" <= c <= "Z" for c in text)}


def failed(m):
    return {"too_few_words": m["n_words"] < 50, "repeated_windows": 100 * m["n_repeat_words"] > 50 * m["n_words"], "many_symbols": 10 * m["n_symbols"] > m["n_words"],
            "repeated_lines": 100 * m["n_dup_lines"] > 50 * m["n_lines"], "short_words": m["word_chars"] < 2 * m["n_words"],
            "long_words": m["word_chars"] > 15 * m["n_words"], "shouting": 100 * m["n_upper"] > 50 * m["word_chars"]}


def _docs(spark, n=250):
    rng = random.Random(1)
    bits = ["a", "bb", "Ccc", "DDDD", "#x", "é&", "word", "\n", "\n", "\t", "  ", "\x0b", " ", "|"]
    rows = [(i, "".join(rng.choice(bits[: rng.choice([3, 8, 14])]) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(160)))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_measures_and_verdicts(spark):
    rows, docs = _docs(spark)
    texts = dict(rows)
    for policy, rules in quality.POLICIES.items():
        got = quality.apply_policy(quality.ledger(docs), policy).collect()
        assert len(got) == len(rows)
        for r in got:
            m = measures(texts[r["doc_id"]])
            assert m == {k: r[k] for k in m}
            f = failed(m)
            assert {x for x in quality.RULES if r["fail_bits"] & quality.bit(x)} == {x for x in f if f[x]}
            assert r["base_failed"] == (f["too_few_words"] or f["repeated_windows"])
            assert r["kept"] == (not r["base_failed"] and not any(f[x] for x in rules))


def test_ablations(spark):
    rows, docs = _docs(spark)
    every = [failed(measures(t)) for _, t in rows]
    rules = quality.POLICIES["2024"]
    for r in quality.ablations(quality.ledger(docs), "2024").collect():
        others = [not any(f[x] for x in rules if x != r["rule"]) for f in every]
        assert r["failed"] == sum(f[r["rule"]] for f in every)
        assert r["failed_alone"] == sum(f[r["rule"]] and o for f, o in zip(every, others))
        assert r["kept_without"] == sum(others)


def test_odd_documents(odd_docs, no_docs, clashing):
    for docs in (odd_docs, clashing):
        texts = Counter((r["doc_id"], tuple(sorted(measures(r["text"]).items()))) for r in docs.collect())
        got = Counter((r["doc_id"], tuple(sorted((k, r[k]) for k in measures("")))) for r in quality.ledger(docs).collect())
        assert got == texts
    assert quality.ledger(no_docs).count() == 0 and quality.ablations(quality.ledger(no_docs), "2025").count() == 0


def test_no_python_in_the_plan(spark):
    _, docs = _docs(spark, 3)
    plan = quality.apply_policy(quality.ledger(docs), "2025")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
