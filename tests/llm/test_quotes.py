import random
import re
from collections import Counter

from pyspark.sql import functions as F

from terroir.llm import quotes

MARKS = re.compile(r"^(?:[ \t]*>)+")


def brute(rows):
    """(reply_to, thread, depth) by (conv, turn), reading one conversation after the other."""
    convs = {}
    for conv, turn, _, text in rows:
        if conv is not None and turn is not None:
            convs.setdefault(conv, []).append((turn, text or ""))
    out = {}
    for conv, messages in convs.items():
        own, parents = {}, {}

        def norm(line):
            return re.sub(r"\s+", " ", MARKS.sub("", line)).strip(" ").lower()

        for turn, text in messages:
            for line in text.split("\n"):
                if not MARKS.match(line) and norm(line):
                    own.setdefault(norm(line), set()).add(turn)
        for turn in {t for t, _ in messages}:
            passages = {}
            for copy, (_, text) in enumerate(m for m in messages if m[0] == turn):
                level, start = 0, 0
                for k, line in enumerate(text.split("\n")):
                    now = (MARKS.match(line) or [""])[0].count(">")
                    if now != level:
                        level, start = now, k
                    if now and norm(line):
                        earlier = [t for t in own.get(norm(line), ()) if t < turn]
                        if earlier:
                            passages.setdefault((now, copy, start), Counter())[max(earlier)] += 1
            best = [(-level, *max((n, t) for t, n in votes.items())) for (level, _, _), votes in passages.items()]
            if best:
                parents[turn] = max(best)[2]
        turns = sorted({t for t, _ in messages})
        for k, turn in enumerate(turns):
            thread, depth = turn, 0
            while thread in parents:
                thread, depth = parents[thread], depth + 1
            out[conv, turn] = (parents.get(turn, turns[k - 1] if k else None), thread, depth)
    return out


def _rows(rng):
    rows = []
    for conv in range(25):
        said = []
        for turn in sorted(rng.sample(range(20_000 if conv % 5 == 0 else 20), rng.randrange(1, 12))):
            lines = []
            for _ in range(rng.randrange(3)):
                if said:
                    depth = rng.randrange(1, 3)
                    lines += ["On Monday A wrote:"] * rng.randrange(2) + [rng.choice([">" * depth + " ", " > " * depth]) + x.upper() for x in rng.choice(said)] + rng.choice([[], [""]])
            mine = [f"{rng.choice(['yes', 'no', 'so  it is', 'fine'])} {rng.randrange(6)}" for _ in range(rng.randrange(1, 4))]
            said.append(mine)
            rows.append((conv, turn, "user", "\n".join(lines + mine)))
    return rows


def test_equals_brute_force(spark):
    rows = _rows(random.Random(8))
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = brute(rows)
    assert {(r["conv_id"], r["turn"]): (r["reply_to"], r["thread"], r["depth"]) for r in got} == want and len(got) == len(rows)
    assert [(r["conv_id"], r["thread"], r["turn"]) for r in got] == sorted((r["conv_id"], r["thread"], r["turn"]) for r in got)
    assert not any(MARKS.match(line) or "wrote:" in line for r in got for line in r["content"].split("\n"))
    assert max(d for _, _, d in want.values()) >= 3


def test_odd_messages(spark):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (None, 1, "user", "> x"), (2, None, "user", "y"), (3, 5, "a", "> self\nself"), (3, 5, "a", "> self\nself"),
            (3, 9, "b", "> self"), (4, 0, "u", "a " * 100_000), (4, 1, "u", "> " + "a " * 100_000 + "\nb")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(1) for c in ("conv", "body", "thread", "parent", "found", "hash", "level", "place")})
    got = quotes.reply_order(frame).collect()
    assert len(got) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in got}
    assert by[1, 0]["content"] is None and by[1, 1]["reply_to"] == 0 and by[None, 1]["reply_to"] is None and by[2, None]["content"] == "y"
    assert by[3, 5]["reply_to"] is None and by[3, 9]["reply_to"] == 5 and by[3, 5]["content"] == "self" and by[4, 1]["thread"] == 0 and by[4, 1]["content"] == "b"
    assert quotes.reply_order(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 0, "u", "a")], "conv_id long, turn long, role string, text string")
    plan = quotes.reply_order(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
