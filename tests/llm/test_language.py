import zlib

import numpy as np

from terroir.llm import language

TEXTS = {"en": "the house stands near the water and they think that this is right ", "fr": "la maison est près de la rivière et ils pensent que cela est vrai ",
         "de": "das haus steht nahe am wasser und sie denken dass dies richtig ist ", "es": "la casa está cerca del río y ellos piensan que esto es cierto ",
         "it": "la casa si trova vicino al fiume ed essi pensano che questo sia vero ", "nl": "het huis staat dichtbij het water en zij denken dat dit juist is "}


def _docs(spark, languages, n=60):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(n):
        name = languages[k % len(languages)]
        picked = " ".join(rng.permutation(TEXTS[name].split())[:9])
        rows.append((k, picked, name, "s", len(picked)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 12, 40):
        code = language.codewords(n, 31)
        assert len({tuple(row) for row in code}) == n
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2 if n < 6 else 8)


def test_held_out_accuracy(spark):
    for languages in (list(TEXTS)[:4], list(TEXTS)):
        docs = _docs(spark, languages, 360)
        model = language.fit(language.learnable(docs))
        assert set(model.languages) == set(languages)
        rows = language.identify(docs, model, keep=("doc_id", "lang")).withColumn("held_out", language.held_out()).collect()
        held = [r for r in rows if r["held_out"]]
        assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)
        assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.9
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_and_labels_are_not_learned(spark):
    docs = _docs(spark, ["en", "fr"])
    from pyspark.sql import functions as F

    spoiled = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    one, two = language.fit(language.learnable(docs)), language.fit(language.learnable(spoiled))
    assert two.languages == ("en", "fr") and np.allclose(one.weights, two.weights)


def test_sample_is_bounded_and_repeatable(spark):
    docs = _docs(spark, ["en", "fr", "de"], 300)
    one, two = (language.fit(docs.repartition(n), sample=150) for n in (1, 5))
    assert np.allclose(one.weights, two.weights, atol=1e-5) and len(one.languages) == 3


def test_one_letter_texts_have_a_language(spark):
    model = language.fit(language.learnable(_docs(spark, ["en", "fr", "de"])))
    texts = spark.createDataFrame([(1, "a"), (2, "Z"), (3, " é "), (4, "7")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify(texts, model).collect()}
    assert all(got[k]["lang_pred"] in model.languages and got[k]["score"] > 0 for k in (1, 2, 3))
    assert got[4]["lang_pred"] == "und" and got[4]["score"] == 0


def test_odd_documents(spark, odd_docs, no_docs, clashing):
    model = language.fit(language.learnable(_docs(spark, ["en", "fr", "de"])))
    for docs in (odd_docs, clashing):
        rows = language.identify(docs, model, keep=("doc_id", "text")).collect()
        assert len(rows) == 13
        for r in rows:
            unknown = r["text"] is None or not any(map(str.isalpha, r["text"]))
            assert (r["lang_pred"] == "und") == unknown and (not unknown or (r["score"] == 0 and r["ambiguous"]))
    assert language.identify(no_docs, model).count() == 0
    nothing = language.fit(no_docs)
    assert nothing.languages == () and {r["lang_pred"] for r in language.identify(odd_docs, nothing).collect()} == {"und"}
    only = language.fit(language.learnable(_docs(spark, ["en"])))
    assert {r["lang_pred"] for r in language.identify(odd_docs, only).collect()} == {"en", "und"}
