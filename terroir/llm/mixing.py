"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of shuffled documents, repeated up to ``epochs`` times. A copy's virtual finish time is the
source's words up to its end, divided by the source's target; the mix is all copies in order of that time, cut where
the total budget is used up. As the targets add up to the budget, that is at time 1 in every queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.session import materialize

from .common import WORD, word_count


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), budget_share: float = 1.0, epochs: int = 3) -> DataFrame:
    """Target words per source from (source, source_size): one row per source, so one task sorts them.

    Sources in code point order, null last, take ``weights`` in turn. A target stops at ``epochs`` times the source's
    size; the excess goes to the others by weight until none is above. Sources with the smallest ceiling per weight
    stop first, so a running sum over them in that order finds where to stop.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ceiling = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    frame = (
        sizes.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", weight)
        .withColumn("ceiling", F.col("source_size").cast("double") * epochs).withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget_share)))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("ceiling").over(by_ceiling), F.lit(0.0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ceiling), F.lit(0.0))))
        .withColumn("stops", F.col("level") >= F.col("ratio"))
    )
    still = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    level = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("ceiling"))).over(everything), F.lit(0.0))) / still
    return frame.select("source", "source_size", F.when(F.col("stops"), F.col("ceiling")).otherwise(level * F.col("weight")).alias("target"))


def fair_queues(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), budget_share: float = 1.0, epochs: int = 3,
                id_col: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """Every row of (id, source, size) with its source's size and target, where it starts in its queue, and its words taken.

    The queue order is md5 of the id, so it is shuffled and the same in every run. A queue is a prefix sum over 4096
    slices by the first digits of that hash: slices are summed first, so no source, however hot, meets in one task.
    ``taken`` counts the words of all epochs; the last copy of a source is cut where the target is reached, so each
    source gives the whole part of its target. Repeated ids follow each other in the queue by size, then by the columns
    ``ties``, which are kept; a null id sorts as the text ``null``. A null source is a source.
    """
    docs = materialize(docs.select(id_col, "source", "size", *ties), "mix_sizes")  # read twice, and far smaller than the texts
    hashed = docs.withColumn("h", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).withColumn("slice", F.substring("h", 1, 3))
    slices = hashed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    goals = targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget_share, epochs)
    offsets = (
        slices.select("source", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")).alias("o")
        .join(goals.alias("g"), F.expr("o.source <=> g.source"))
        .select(F.col("o.source").alias("o_source"), F.col("o.slice").alias("o_slice"), "base", "source_size", "target")
    )
    within = Window.partitionBy("source", "slice").orderBy("h", F.col(id_col).asc_nulls_last(), "size", *ties).rowsBetween(Window.unboundedPreceding, 0)
    queued = (
        hashed.withColumn("upto", F.sum("size").over(within))
        .join(offsets, F.expr("source <=> o_source AND slice = o_slice"))
        .withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("base", "upto", "o_source", "o_slice", "slice", "h")
    )
    whole = F.floor("target")
    copies = [F.greatest(F.lit(0), F.least(F.col("size"), whole - F.col("source_size") * e - F.col("start"))) for e in range(epochs)]
    return queued.withColumn("taken", sum(copies[1:], copies[0]).cast("long"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", weights: tuple[float, ...] = (1, 2, 3),
        budget_share: float = 1.0, epochs: int = 3) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, repeated as taken and range-sorted by virtual finish time.

    Every row has its own place in the queue; rows that repeat an id, a null one too, follow each other by size and by
    hashes of their text and other columns, so that every run cuts the same one. The copy that the budget cuts keeps its
    first words, parted by single blanks; copies without a word left, and documents without words, are not in the mix.
    An empty table gives an empty mix. Columns and types are those of ``docs``.
    """
    columns = docs.columns
    others = [c for c in columns if c not in (text, source, id_col)]
    ties = ("mix_text__", "mix_rest__")
    rest = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long")
    docs = docs.withColumns({"mix_text__": F.xxhash64(text), "mix_rest__": rest})
    queue = fair_queues(
        docs.select(F.col(id_col).alias("mix_id__"), F.col(source).alias("source"), word_count(text).alias("size"), *ties),
        weights, budget_share, epochs, "mix_id__", ties)
    # Rows alike in everything stand in a row, so their places follow from the first one's.
    queue = queue.groupBy("mix_id__", "source", "size", *ties).agg(
        F.min("start").alias("mix_start__"), F.count("*").alias("mix_rows__"), F.max("taken").alias("taken"),
        F.first("source_size").alias("mix_total__"), F.first("target").alias("mix_target__"),
    ).where("taken > 0").select(
        "mix_id__", F.col("source").alias("mix_source__"),
        F.col("size").alias("mix_size__"), "mix_start__", "mix_rows__", "mix_total__", "mix_target__",
        *[F.col(c).alias(f"{c}own") for c in ties])
    same = F.col(id_col).eqNullSafe(F.col("mix_id__")) & F.col(source).eqNullSafe(F.col("mix_source__"))
    for c in ties:
        same = same & (F.col(c) == F.col(f"{c}own"))
    one = docs.join(queue.where("mix_rows__ = 1"), same)
    alike = docs.join(queue.where("mix_rows__ > 1"), same)
    place = F.row_number().over(Window.partitionBy("mix_id__", "mix_source__", *ties).orderBy("mix_start__")) - 1
    alike = alike.withColumn("mix_start__", F.col("mix_start__") + F.col("mix_size__") * place)
    copies = one.union(alike).withColumn(
        "mix_before__", F.explode(F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: e * F.col("mix_total__") + F.col("mix_start__"))))
    copies = copies.withColumn("mix_words__", F.least("mix_size__", F.floor("mix_target__") - F.col("mix_before__"))).where("mix_words__ > 0")
    words = F.array_remove(F.split(F.col(text), WORD.replace("[^", "[") ), "")
    first = F.array_join(F.slice(words, F.lit(1), F.col("mix_words__").cast("int")), " ")
    ordered = copies.withColumn("mix_finish__", (F.col("mix_before__") + F.col("mix_words__")) / F.col("mix_target__"))
    ordered = ordered.withColumn(text, F.when(F.col("mix_words__") < F.col("mix_size__"), first).otherwise(F.col(text)))
    return ordered.repartitionByRange("mix_finish__", "mix_id__").sortWithinPartitions("mix_finish__", "mix_id__", *ties).select(*columns)
