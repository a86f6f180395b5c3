"""URL verdicts from rules and from the link graph of hosts.

Trust flows from hosts of allowed pages along links, distrust from hosts of blocked pages against them; a host with
clearly more distrust than trust is blocked. All of it is column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.session import materialize

Rules = tuple[tuple[str, str], ...]


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    found = F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str | Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule (its host and path as one text) that fits: its host or a subdomain, and a path starting with its own.

    ``rules`` are (verdict, rule) pairs, a list given by hand of at most some hundred.
    """
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst): distinct edges between different hosts.

    Absolute and protocol-relative ``href`` and ``src`` of the pages, and for each host the domain above it, so that
    subdomains hang together. Links within a host are no edges.
    """
    targets = F.regexp_extract_all(F.col(html), F.lit("(?i)(?:href|src)\\s*=\\s*[\"']?(?:https?:)?//([^/?#\"'\\s>]+)"), F.lit(1))
    links = pages.where(F.col(html).contains("//")).select(F.col(host).alias("src"), F.explode(F.array_distinct(targets)).alias("dst"))
    links = links.select("src", F.translate("dst", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("dst"))
    # Every domain above a host, down from the host itself: a.b.c, b.c, c.
    labels = F.split("host", "\\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    above = pages.select(F.col(host).alias("host")).distinct().where("host <> ''").select(chain.alias("chain"))
    above = above.select(F.explode(F.arrays_zip(F.col("chain").alias("src"), F.slice("chain", F.lit(2), F.size("chain")).alias("dst"))).alias("e"))
    above = above.select("e.src", "e.dst").where("dst IS NOT NULL AND contains(dst, '.')")
    return links.union(above).where("src <> '' AND dst <> '' AND src <> dst").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-7, max_rounds: int = 1000) -> DataFrame:
    """(host, trust, distrust) by personalised PageRank, run until it converges.

    ``seeds`` is (host, kind, weight), kind ``trust`` or ``distrust``. Trust leaves a host in equal parts over its
    links, distrust in equal parts over the links that point to it. One table holds both directions, so a step is one
    join and one sum; sums are combined before the shuffle and a hub's edges are a skewed join that Spark splits.
    Steps go on until the scores of a step differ from those of the step before by less than ``tolerance`` in all
    (both kinds, each kind's seeds adding up to 1); every step is written to the shared folder. ``max_rounds`` is a
    safety stop that raises, not a cut: the change shrinks by the damping at every step, so 1e-7 takes about 100.
    """
    both = edges.select("src", "dst", F.lit("trust").alias("kind")).union(edges.select(F.col("dst"), F.col("src"), F.lit("distrust")))
    degree = both.groupBy("src", "kind").agg(F.count("*").alias("degree"))
    flows = materialize(both.join(degree, ["src", "kind"]).select("src", "kind", "dst", (F.lit(damping) / F.col("degree")).alias("share")), "host_flows")
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = materialize(seeds.groupBy("host", "kind").agg(F.sum("weight").alias("weight")).join(total, "kind").select(
        "host", "kind", (F.col("weight") / F.col("total")).alias("score")), "host_seeds")
    base = start.select("host", "kind", (F.col("score") * (1 - damping)).alias("score"))
    state = start
    for _ in range(max_rounds):
        moved = state.withColumnRenamed("host", "src").join(flows, ["src", "kind"]).select(
            F.col("dst").alias("host"), "kind", (F.col("score") * F.col("share")).alias("score"))
        new = materialize(moved.union(base).groupBy("host", "kind").agg(F.sum("score").alias("score")), "host_scores")
        change = new.join(state.withColumnRenamed("score", "was"), ["host", "kind"], "full").agg(
            F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))))).first()[0]
        state = new
        if not change or change < tolerance:
            break
    else:
        raise RuntimeError(f"host scores did not converge in {max_rounds} rounds")
    return state.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules: Rules, id_col: str = "page_id", url: str = "url", html: str = "html", damping: float = 0.85,
          tolerance: float = 1e-7, threshold: float = 1.0) -> DataFrame:
    """Per page: the id, host, path, rule (or null), verdict, and its host's trust and distrust.

    Pages that a rule fits take its verdict and seed their host, once per page, with trust or distrust. Others are
    blocked if their host's distrust is over ``threshold`` times its trust; hosts that no flow reaches are allowed. Null
    urls and those without ``://`` have an empty host, which no edge touches. Repeated rows count again as seeds and
    each get a row; null html has no links.
    """
    parsed = pages.select(F.col(id_col).alias("id__"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html).alias("html"))
    ruled = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)]) if rules else F.create_map().cast("map<string,string>")
    slim = materialize(ruled.select("id__", "host", "path", "rule", F.element_at(verdicts, F.col("rule")).alias("given")), "ruled_pages")
    kind = F.when(F.col("given") == "allow", "trust").otherwise("distrust")
    seeds = slim.where("given IS NOT NULL AND host <> ''").groupBy("host", kind.alias("kind")).agg(F.count("*").cast("double").alias("weight"))
    scores = materialize(propagate(host_edges(parsed), seeds, damping, tolerance), "hosts_judged")
    judged = slim.join(scores, "host", "left")
    bad = F.coalesce(F.round("distrust", 12) > F.round(F.col("trust") * threshold, 12), F.lit(False))
    verdict = F.coalesce("given", F.when(bad, "block").otherwise("allow"))
    return judged.select(F.col("id__").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
