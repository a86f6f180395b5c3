"""Quotation linking: conversations in reply order, without quotes.

A line's level is the number of ``>`` before it. Consecutive lines of one level from 1 on are a quoted passage. Its
lines are normalised and hashed, and joined to the own lines of earlier messages of the conversation; the message that
most lines of the passage come from is its original. All of it is column expressions, joins and windows of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.session import materialize

# The line that mail programs put above a quote, in the languages of the tables.
ATTRIBUTION = "^\\s*(?:On|Le|Am|El)\\b.*(?:wrote|écrit|schrieb|escribió)\\s*:?\\s*$"
_MARKS = "^(?:[ \\t]*>)+"
# Turns that one window holds; what came before them is carried over.
_TURNS = 4096


def _lines(messages: DataFrame) -> DataFrame:
    """Every line with its place, level and normalised hash (null for a blank line)."""
    lines = messages.select("conv", "turn", F.posexplode(F.split("body", "\n")).alias("place", "line"))
    marks = F.regexp_extract("line", _MARKS, 0)
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace("line", _MARKS, ""), "[\\s]+", " ")))
    return lines.withColumn("level", F.length(marks) - F.length(F.translate(marks, ">", ""))).withColumn(
        "hash", F.when(plain != "", F.sha2(plain, 256)))


def without_quotes(text):
    """The text without quoted lines, without the attribution line above a quote, and without blank lines at its ends."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")

    def own(all_lines):
        return F.filter(all_lines, lambda line, k: ~line.rlike(_MARKS) & ~(
            line.rlike(ATTRIBUTION) & F.coalesce(F.get(all_lines, k + 1).rlike(_MARKS), F.lit(False))))

    kept = F.element_at(F.transform(F.array(lines), own), 1)
    return F.when(text.rlike("(?m)" + _MARKS), F.regexp_replace(F.array_join(kept, "\n"), "^\\s+|\\s+$", "")).otherwise(text)


def latest_before(asked: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """``asked`` (keys, turn, ...) with ``found``: the largest turn below its own of ``given`` (keys, turn), or null.

    Windows hold 4096 turns of a key; the latest turn of earlier stretches is carried over from one row per stretch.
    """
    stretch = F.floor(F.col("turn") / _TURNS).alias("stretch")
    ends = given.groupBy(*keys, stretch).agg(F.max("turn").alias("end"))
    known = asked.select(*keys, stretch).distinct().join(ends, [*keys, "stretch"], "full")
    earlier = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = known.select(*keys, "stretch", F.max("end").over(earlier).alias("carried"))
    rest = [c for c in asked.columns if c not in (*keys, "turn")]
    both = asked.select(*keys, "turn", stretch, F.lit(None).cast("long").alias("at"), F.struct(*rest, F.lit(1).alias("one__")).alias("rest")).unionByName(
        given.select(*keys, "turn").distinct().select(*keys, "turn", stretch, F.col("turn").alias("at")), allowMissingColumns=True)
    below = Window.partitionBy(*keys, "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("at").over(below)).where("rest IS NOT NULL")
    return near.join(carried, [*keys, "stretch"], "left").select(*keys, "turn", *[F.col(f"rest.{c}").alias(c) for c in rest], F.coalesce("near", "carried").alias("found"))


def originals(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent): the message that a message answers by its quotes, for those whose quotes have an original.

    A passage comes from the message with most of its lines, each line counting for its latest earlier message; then a
    message answers the original of its shallowest passage with most lines. Ties go to the later message.
    """
    quoting = messages.where(F.col("body").rlike("(?m)" + _MARKS))
    lines = materialize(_lines(messages.join(quoting.select("conv").distinct(), "conv", "left_semi")), "message_lines")
    quoted = lines.where("level > 0")
    # Lines of one level that follow each other: their place minus their rank among the level's lines is the same.
    same = Window.partitionBy("conv", "turn", "level").orderBy("place")
    quoted = quoted.withColumn("passage", F.col("place") - F.row_number().over(same)).where("hash IS NOT NULL").select("conv", "turn", "level", "passage", "hash")
    own = lines.where("level = 0 AND hash IS NOT NULL").select("conv", "hash", "turn").distinct()
    linked = latest_before(quoted, own, ["conv", "hash"]).where("found IS NOT NULL")
    votes = linked.groupBy("conv", "turn", "level", "passage", "found").agg(F.count("*").alias("n"))
    passages = votes.groupBy("conv", "turn", "level", "passage").agg(F.max(F.struct("n", "found")).alias("best"))
    return passages.groupBy("conv", "turn").agg(F.max(F.struct((-F.col("level")).alias("level"), "best.n", "best.found")).alias("best")).select(
        "conv", "turn", F.col("best.found").alias("parent"))


def _roots(links: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth): links followed to their end by doubling the step in every round."""
    state = materialize(links.select("conv", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")), "quote_threads")
    while True:
        above = state.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("next"), F.col("depth").alias("more"))
        step = state.join(above, (F.col("conv") == F.col("c")) & (F.col("thread") == F.col("t")), "left")
        if step.where("next IS NOT NULL").limit(1).count() == 0:
            return state
        state = materialize(step.select("conv", "turn", F.coalesce("next", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "quote_threads")


def reply_order(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every message as (conv, turn, role, content, quoted_lines, reply_to, thread, depth), sorted in reply order.

    content is the text without quotes. reply_to is the turn of the quoted original, else the latest earlier turn of the
    conversation. thread is the turn that quotes lead up to (its own without quotes) and depth the number of links on
    the way. Rows are range-sorted by conversation, thread and turn, so answers follow what they quote and no
    conversation has to fit into one task.

    Null and empty texts are messages without quotes. Messages without conversation or turn stand alone: no reply_to,
    thread is the turn. Rows that repeat a turn share its links. A quote without original, or of itself, links nothing.
    """
    rows = messages.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("body"))
    placed = rows.where("conv IS NOT NULL AND turn IS NOT NULL")
    links = materialize(originals(placed), "quote_links")
    threads = _roots(links).join(links, ["conv", "turn"])
    turns = placed.select("conv", "turn").distinct()
    before = latest_before(turns, turns, ["conv"]).select("conv", "turn", F.col("found").alias("previous"))
    starts = F.size(F.array_compact(F.transform(F.split("body", "\n"), lambda line: F.when(line.rlike(_MARKS), 1))))
    joined = rows.join(before, ["conv", "turn"], "left").join(threads, ["conv", "turn"], "left")
    out = joined.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), without_quotes(F.col("body")).alias("content"),
        F.greatest(F.coalesce(starts, F.lit(0)), F.lit(0)).cast("long").alias("quoted_lines"),
        F.coalesce("parent", "previous").alias("reply_to"), F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
    return out.repartitionByRange(conv, "thread", turn).sortWithinPartitions(conv, "thread", turn)
