"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fim, hosts, language, lines, mixing, near_duplicates, neighbours, packing, passages, quality, quality_mil, quotes, runs
from .common import WORD, table, word_count


# The rules of the contract of op2, in its order.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), "2025").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_repeated_lines(docs.withColumn("whole", F.length("text"))).withColumnRenamed("text", "kept_text")
    return kept.select("doc_id", "kept_text", (F.col("whole") - F.length("kept_text")).cast("long").alias("removed_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    return mixing.fair_queues(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(language.learnable(docs))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(table(spark, sf_dir, "documents"), seed=runs.contract_seed())
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("key"), r["start"].alias("start"), r["period"].alias("period"),
                                                              r["length"].alias("length"))))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    return found.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, buckets = quality_mil.fit(language.learnable(docs), table(spark, sf_dir, "labels"))
    return quality_mil.score_docs(docs, model, buckets).select(
        "doc_id", language.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return written.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                          F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_filters": op2_url_filters,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_near_passages": op6_near_passages,
    "op7_mixing": op7_mixing,
    "op8_quotation_linking": op8_quotation_linking,
    "op9_language": op9_language,
    "op10_neighbours": op10_neighbours,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LEDGER = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM documents),
 windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
 marked AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM windows WHERE n > 1) GROUP BY doc_id),
 m AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(t) - length(regexp_replace(t, '[{quality.SYMBOLS}]', '', 'g')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(marked.n, 0) AS n_repeat_words, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper FROM d LEFT JOIN marked ON marked.doc_id = d.doc_id)"""
_BITS = " + ".join(f"CASE WHEN {condition} THEN {quality.bit(rule)} ELSE 0 END" for rule, condition in quality.RULES.items())

_SHINGLES = f"""s AS (SELECT doc_id, w, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
   ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])) END AS grams
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents)),
 g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
 links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
 edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
 reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)"""

_BLANKS = "[\\x20\\x09-\\x0D]+"

_HEX = "('0x' || substr(h, {}, 8))::UBIGINT"
_FIM = f"""WITH u AS (SELECT doc_id, t, regexp_extract_all(t, '{fim.UNIT}') AS units,
   {_HEX.format(1)} AS h1, {_HEX.format(9)} AS h2, {_HEX.format(17)} AS h3, {_HEX.format(25)} AS h4
  FROM (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents)),
 c AS (SELECT *, len(units) AS n, CASE WHEN doc_id IS NULL OR t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
   OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
  least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi FROM u),
 p AS (SELECT *, array_to_string(units[1:lo], '') AS pre, array_to_string(units[lo + 1:hi], '') AS mid,
  array_to_string(units[hi + 1:], '') AS suf FROM c)
 SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
   ELSE t END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": f"""{_LEDGER}, f AS (SELECT *, {_BITS} AS bits FROM m)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & {quality.mask("base")} <> 0 AS base_failed,
  bits & {quality.mask("2025") | quality.mask("base")} = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits FROM f""",
    "op3_near_duplicates": f"""WITH RECURSIVE {_SHINGLES}, low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
 SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(low.b, s.doc_id)) AS component_id,
  s.doc_id <= coalesce(low.b, s.doc_id) AS kept FROM s LEFT JOIN low ON low.a = s.doc_id""",
    "op4_line_dedup": f"""WITH l AS (SELECT doc_id, line, i, regexp_replace(line, '^{_BLANKS}|{_BLANKS}$', '', 'g') AS plain FROM
   (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
 runs AS (SELECT doc_id, i, lead(i) OVER o AS i2, lead(i, 2) OVER o AS i3, plain AS a, lead(plain) OVER o AS b, lead(plain, 2) OVER o AS c FROM l
  WHERE plain <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS rn FROM runs WHERE c IS NOT NULL),
 gone AS (SELECT DISTINCT doc_id, unnest([i, i2, i3]) AS i FROM ranked WHERE rn > 1),
 kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM l ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
 SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS kept_text,
  length(d.text) - length(CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END) AS removed_chars FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op7_mixing": f"""WITH s AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
 src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s GROUP BY source),
 w AS (SELECT *, place % 3 + 1e0 AS weight, 3e0 * source_size AS ceiling, 3e0 * source_size / (place % 3 + 1e0) AS ratio FROM src),
 v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER o, 0e0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0e0)) >= ratio AS stops
  FROM w WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 t AS (SELECT *, CASE WHEN stops THEN ceiling ELSE (sum(source_size) OVER () - coalesce(sum(CASE WHEN stops THEN ceiling END) OVER (), 0e0))
   / sum(CASE WHEN NOT stops THEN weight END) OVER () * weight END AS target FROM v),
 q AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id NULLS LAST, size
   ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM s)
 SELECT doc_id, size, source_size, target, CAST(greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - source_size - start))
  + greatest(0, least(size, floor(target) - 2 * source_size - start)) AS BIGINT) AS taken FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source""",
    "op13_fill_in_middle": _FIM,
}
