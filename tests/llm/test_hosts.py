import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terroir.llm import hosts
from terroir.llm.queries import URL_RULES


def split(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]) if found else ("", "")


def rule(host, path, rules=URL_RULES):
    fits = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def edges(pages):
    out = set()
    for _, url, html in pages:
        host = split(url)[0]
        for link in re.findall(r"(?i)(?:href|src)\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)", html or ""):
            out.add((host, link.lower()))
        while "." in host:
            above = host.split(".", 1)[1]
            if "." in above:
                out.add((host, above))
            host = above
    return {(a, b) for a, b in out if a and b and a != b}


def ranks(pages, d=0.85, tolerance=1e-7):
    """Both kinds stepped together until the scores of a step change by less than ``tolerance`` in all."""
    e = edges(pages)
    flows = {"allow": e, "block": {(b, a) for a, b in e}}
    base, state = {}, {}
    for kind, flow in flows.items():
        seeds = Counter(split(u)[0] for _, u, _ in pages if rule(*split(u))[1] == kind and split(u)[0])
        base[kind] = {h: n / seeds.total() for h, n in seeds.items()}
        state[kind] = dict(base[kind])
    while True:
        change = 0.0
        for kind, flow in flows.items():
            degree = Counter(a for a, _ in flow)
            new = defaultdict(float)
            for h, x in base[kind].items():
                new[h] += (1 - d) * x
            for a, b in flow:
                if a in state[kind]:
                    new[b] += d * state[kind][a] / degree[a]
            change += sum(abs(new.get(h, 0) - state[kind].get(h, 0)) for h in set(new) | set(state[kind]))
            state[kind] = new
        if change < tolerance:
            return state


def _pages(rng, n=300):
    names = ["x.com", "www.example.com", "example.com", "a.example.com", "b.net", "c.d.net", "e.org", "f.g.org", "spam.org", "Net", "com"]
    rows = []
    for i in range(n):
        url = rng.choice(["http://", "HTTPS://", "//", "", "x://y://"]) + rng.choice(names) + rng.choice(["", "/", "/en/1", "/es/2?q", "/fr/", "?/es/", "#/fr/"])
        links = "".join(rng.choice([f'<a href="http://{rng.choice(names)}/p">', f"<img src='//{rng.choice(names).upper()}'>", '<a href="/en/">']) for _ in range(rng.randrange(4)))
        rows.append((i, url if rng.random() < 0.95 else None, links if rng.random() < 0.95 else None))
    return rows


def test_equals_brute_force(spark):
    rows = _pages(random.Random(2))
    got = {r["page_id"]: r for r in hosts.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    scores = ranks(rows)
    assert len(got) == len(rows)
    seen = set()
    for i, url, _ in rows:
        host, path = split(url)
        chosen, verdict = rule(host, path)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, chosen)
        trust, distrust = scores["allow"].get(host, 0), scores["block"].get(host, 0)
        assert (r["trust"] or 0) == pytest.approx(trust, abs=1e-9) and (r["distrust"] or 0) == pytest.approx(distrust, abs=1e-9)
        assert r["verdict"] == (verdict or ("block" if round(distrust, 12) > round(trust, 12) else "allow"))
        seen.add((chosen, r["verdict"]))
    assert len(seen) >= 6


def test_hot_host_and_clashing_columns(spark):
    rows = [(i, f"http://hub.org/{i}", '<a href="http://bad.net/es/x">') for i in range(3000)] + [(9000 + i, "http://bad.net/es/1", "") for i in range(3)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "id__", "src", "dst", "given")})
    got = hosts.judge(docs, URL_RULES).groupBy("host", "verdict").count().collect()
    assert {(r["host"], r["verdict"], r["count"]) for r in got} == {("hub.org", "block", 3000), ("bad.net", "block", 3)}


def test_long_chain_converges(spark):
    """50 hosts in a chain that leads to a blocked one: all of them get distrust and are blocked."""
    rows = [(k, f"http://h{k}.org/", f'<a href="http://h{k + 1}.org/">') for k in range(50)] + [(50, "http://bad.net/es/x", "")]
    rows[49] = (49, "http://h49.org/", '<a href="http://bad.net/">')
    got = {r["page_id"]: r for r in hosts.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    assert all(got[k]["verdict"] == "block" and got[k]["distrust"] > 0 for k in range(50))
    assert got[0]["distrust"] == pytest.approx(0.15 * 0.85**50, rel=1e-3)


def test_empty_tables_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert hosts.judge(none, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/x", None), (1, "http://a.com/x", None), (None, None, None)], "page_id long, url string, html string")
    assert [r["verdict"] for r in hosts.judge(one, ()).collect()] == ["allow"] * 3
