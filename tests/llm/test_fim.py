import hashlib
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from terroir.llm import fim, queries


def units(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


@given(st.text(alphabet="ab\n\r é😀", max_size=60))
@settings(max_examples=300, deadline=None)
def test_unit_ends_equal_findall(text):
    found = units(text)
    ends = [sum(map(len, found[: k + 1])) for k in range(len(found))]
    assert fim.unit_ends(text) == ends


def test_every_form_restores(spark, odd_docs):
    rows = odd_docs.withColumn("text", odd_docs.text).collect()
    got = fim.fill_in_middle(odd_docs).withColumn("restored", fim.restore(fim.F.col("output"), fim.F.col("form"))).collect()
    assert len(got) == len(rows)
    for r, g in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")),
                    sorted(got, key=lambda g: (g.doc_id is None, g.doc_id or 0, g.restored or "")), strict=True):
        assert g.restored == (r.text or "")
        assert g.n == len(units(r.text or ""))
        if r.doc_id is None or not r.text:
            assert g.form == "plain" and g.prefix_chars is None


def test_markers_and_long_texts(spark):
    long = "line\n" * 200_000 + "tail"
    rows = [(1, "a<S>b\nc\nd"), (2, "x <M>"), (3, long), (4, "\n\n\n"), (5, None)]
    got = {r.doc_id: r for r in fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
           .withColumn("restored", fim.restore(fim.F.col("output"), fim.F.col("form"))).collect()}
    assert got[1].form == got[2].form == got[5].form == "plain" and got[1].output == "a<S>b\nc\nd"
    assert got[3].n == 200_001 and got[3].restored == long and got[3].form in ("psm", "spm")
    assert got[4].n == 3 and got[4].restored == "\n\n\n"


def test_clashing_columns_and_empty(spark, clashing, no_docs):
    assert fim.fill_in_middle(clashing).count() == clashing.count()
    assert fim.fill_in_middle(no_docs).count() == 0


def test_query_equals_sql(spark, sf):
    got = sorted(tuple(r) for r in queries.op13_fill_in_middle(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(tuple(r) for r in con.execute(queries.ORACLE_SQL["op13_fill_in_middle"]).fetchall())
    assert got == want
    forms = {r[2] for r in got}
    assert {"psm", "spm"} <= forms
    text = con.execute("SELECT text FROM documents WHERE doc_id = 0").fetchone()[0]
    assert any(r[0] == 0 and r[6] == hashlib.sha256(text.encode()).hexdigest() for r in got)
