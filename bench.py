"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the tables and the local cores. Every query is run to its end (all rows, all
columns) once after a small warm-up; files that queries write go to a fresh
folder. BENCH_TWICE=1 runs each a second time and reports that as well: the
difference is planning and code generation, the rest follows the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINES = (
    "filter_listings", "text_search", "upsert_listings", "listing_normalize", "geocode_fallback", "market_to_listings",
    "topk_similar", "compare_pairs", "unpivot_property_types", "join_fact_hierarchy", "rollup_department", "rollup_hierarchy",
    "rollup_prices_unweighted", "dataset_profile", "sink_parquet_partitioned", "sentiment_light", "sentiment_by_year",
    "top_terms", "sentiment_doc", "nlp_term_hits", "percentile_score", "liquidity_index", "score_where_to_live",
    "exploration_frame", "discover_links", "page_extract_layers", "stream_offsets_bounded", "stream_sentiment_state",
)


def main() -> None:
    from suite import all_cases
    from terroir.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        "terroir.suite.spread": cpus,
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    cases = all_cases()
    for name in ("filter_listings", "score_fn_hook"):
        cases[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    def timed(name: str) -> float:
        start = time.perf_counter()
        cases[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds: dict[str, float] = {}
    again: dict[str, float] = {}
    for name in HEADLINES:
        seconds[name] = timed(name)
        if os.environ.get("BENCH_TWICE") == "1":
            again[name] = timed(name)
        print(f"{name}: {seconds[name]} {again.get(name, '')}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    } | ({"second_run": again} if again else {})))
    spark.stop()


if __name__ == "__main__":
    main()
