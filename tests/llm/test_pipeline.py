"""The pipeline stage by stage on the smallest tables, each against a plain version on its own input."""

from collections import Counter, defaultdict

import pytest
from llm_words import words
from test_lines import brute as without_lines
from test_mixing import taken, targets
from test_near_duplicates import brute as components

import corpus_pipeline
from terroir.llm import language, queries
from terroir.llm.common import table


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, "/root/testdata/sf0.001")
        rows = result.collect()
        out[name] = (docs.collect(), rows)
        if name != "packing":
            assert result.columns == docs.columns and result.dtypes == docs.dtypes
            docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_language_keeps_clean_documents(spark, stages):
    before, after = stages["language_id"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == set()
    model = language.fit(language.learnable(table(spark, "/root/testdata/sf0.001", "documents")))
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "123 !", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert language.identify(odd, model).where("NOT ambiguous").count() == 0


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    want = {i: text for (i, _), text in without_lines([(r["doc_id"], r["text"]) for r in before], 3).items()}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    found, _ = components([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert sorted(r["doc_id"] for r in after) == sorted(set(found.values()))


def test_mixing(stages):
    before, after = stages["mixing"]
    sized = [(r["doc_id"], r["source"], len(words(r["text"]))) for r in before]
    sizes = defaultdict(int)
    for _, source, size in sized:
        sizes[source] += size
    want = {d: n[0] for d, n in taken(sized, targets(sizes)).items() if n[0]}
    got = Counter()
    for r in after:
        got[r["doc_id"]] += len(words(r["text"]))
    assert dict(got) == want


def test_packing(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in before} == {r["doc_id"] for r in after}
    filled = Counter()
    for r in after:
        filled[r["sequence_id"]] += r["length"]
    assert all(n == 4096 or n & (n - 1) == 0 for n in filled.values())
    copies = Counter(r["doc_id"] for r in before)
    held = defaultdict(Counter)
    for r in after:
        held[r["doc_id"]]["tokens"] += r["length"]
    assert all(held[d]["tokens"] >= n for d, n in copies.items())


def test_odd_documents(spark, odd_docs, no_docs, clashing):
    labelled = table(spark, "/root/testdata/sf0.001", "documents")
    for docs in (odd_docs.union(labelled), no_docs, clashing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns
