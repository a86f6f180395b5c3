import random

from llm_words import words

from terroir.llm import lines

GAPS = " \t\n\x0b\x0c\r"


def brute(rows, run):
    """Texts by (id, text) with every line deleted that lies in a run that stood before."""
    seen, out = set(), {}
    known = sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    for key in known:
        all_lines = key[1].split("\n")
        full = [(k, x.strip(GAPS)) for k, x in enumerate(all_lines) if x.strip(GAPS)]
        gone = set()
        for s in range(len(full) - run + 1):
            window = tuple(x for _, x in full[s : s + run])
            if window in seen:
                gone |= {k for k, _ in full[s : s + run]}
            seen.add(window)
        out[key] = "\n".join(x for k, x in enumerate(all_lines) if k not in gone)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice(["a", "b", " c", "d ", "", "e f", "g\t"]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    for run in (1, 2, 3, 5):
        got = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), run).collect()}
        want = {i: t for (i, _), t in brute(rows, run).items()}
        assert got == want


def test_hot_passage(spark):
    rows = [(i, f"own {i}\nx one\nx two\nx three\nlast {i}") for i in range(3000)]
    got = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"own {i}\nlast {i}" for i in range(1, 3000))


def test_odd_documents(odd_docs, no_docs, clashing):
    want = brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()], 3)
    for docs in (odd_docs, clashing):
        out = lines.drop_repeated_lines(docs)
        assert out.columns == docs.columns and out.count() == 13
        before = {(r["doc_id"], r["n_chars"]): r["text"] for r in docs.collect()}
        for r in out.collect():
            text = before[(r["doc_id"], r["n_chars"])]
            assert r["text"] == (None if text is None else want[(r["doc_id"], text)])
    assert lines.drop_repeated_lines(no_docs).count() == 0


def brute_words(rows, run, passage):
    """The same with shorter runs that hold ``passage`` words, and whole texts of fewer lines than ``run``."""
    seen, out = set(), {}
    for key in sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        all_lines = key[1].split("\n")
        full = [(k, x.strip(GAPS)) for k, x in enumerate(all_lines) if x.strip(GAPS)]
        gone = set()
        for width in range(1, run + 1):
            for s in range(len(full) - width + 1):
                window = tuple(x for _, x in full[s : s + width])
                if width == run or width == len(full) or sum(len(words(x)) for x in window) >= passage:
                    if window in seen:
                        gone |= {k for k, _ in full[s : s + width]}
                    seen.add(window)
        out[key] = "\n".join(x for k, x in enumerate(all_lines) if k not in gone)
    return out


def test_few_lines_of_many_words(spark):
    long = [" ".join(f"l{k}w{j}" for j in range(20 + 10 * k)) for k in range(6)]
    schema = "doc_id long, text string"
    # A copy of one line, a copy of two, a long line in other company, two lines of 50 words together, and shorter ones.
    rows = [(0, long[4]), (1, long[4]), (2, "x\ny"), (3, "x\n\n y"), (4, f"a\n{long[5]}\nb"), (5, f"c\n{long[5]}\nd"),
            (6, f"e\n{long[0]}\n{long[1]}\nf"), (7, f"g\n{long[0]}\n{long[1]}\nh"), (8, f"i\n{long[2]}\nj\nk"), (9, f"l\n{long[2]}\nm\nn"), (10, "x")]
    got = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(spark.createDataFrame(rows, schema), passage=50).collect()}
    changed = {1: "", 3: "", 5: "c\nd", 7: "g\nh"}
    assert {i: t for i, t in got.items() if t != dict(rows)[i]} == changed
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice([*long, "a", "b ", "", "c d"]) for _ in range(rng.choice([1, 1, 2, 3, 8])))) for i in range(300)]
    for run in (1, 2, 3, 4):
        got = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(spark.createDataFrame(rows, schema), run, passage=50).collect()}
        assert got == {i: t for (i, _), t in brute_words(rows, run, 50).items()}
