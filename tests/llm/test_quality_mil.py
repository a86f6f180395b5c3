import numpy as np
import pyarrow as pa
import pytest

from terroir.llm import quality_mil, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op12_quality_classifier(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(got[r.doc_id].score, r.quality, got[r.doc_id].predicted) for r in labels if got[r.doc_id].held_out]
    scores, truth, predicted = (np.array(x) for x in zip(*held, strict=True))
    pos, neg = scores[truth == 1], scores[truth == 0]
    auc = (pos[:, None] > neg[None, :]).mean()
    assert auc > 0.9 and (predicted == truth).mean() > max(truth.mean(), 1 - truth.mean())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_attention_follows_the_bad_passage():
    good = "the river runs under the old bridge and people walk along it"
    bad = "BUY!! NOW!! CHEAP!! CLICK!! HERE!! FREE!!"
    texts = [good + "\n" + good if k % 2 else good + "\n" + bad for k in range(80)]
    model = quality_mil.train(texts, np.array([k % 2 for k in range(80)], float), buckets=1 << 10, epochs=80)
    y = quality_mil.score(model, pa.array([good + "\n" + good, bad + "\n" + good, None, ""]), 1 << 10)
    assert y[0] > 0.8 > 0.2 > y[1] and y[2] == y[3] == pytest.approx(1 / (1 + np.exp(-model.b)))


def test_odd_rows(spark, odd_docs, clashing, no_docs):
    model = quality_mil.train([], np.zeros(0))
    got = quality_mil.score_docs(odd_docs, model, 1 << 15).collect()
    assert len(got) == odd_docs.count() and all(r.score == 0.5 for r in got)
    trained, buckets = quality_mil.fit(odd_docs, spark.createDataFrame([(6, 1), (7, 0), (4, 1), (None, 1)], "doc_id long, quality int"), epochs=5)
    scores = {}
    for r in quality_mil.score_docs(clashing, trained, buckets).collect():
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert len(scores[5]) == 1 and all(0 <= s <= 1 for v in scores.values() for s in v)
    assert quality_mil.score_docs(no_docs, trained, buckets).count() == 0
