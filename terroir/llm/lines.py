"""Removal of runs of lines that stood before, found by winnowing over line hashes.

Of every window of ``run`` consecutive lines the one with the smallest hash is its fingerprint, so two equal runs of
that length always share one. Positions of a fingerprint that occurs more than once are joined, and a match is
extended both ways over the windows around it. Lines of a run whose first occurrence is elsewhere are deleted.
With ``passage`` shorter windows are taken as well where they hold so many words, and whole texts of fewer lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.session import materialize

from .common import _GAP, Hasher, bytes_of, mix, small_batches, word_ranges

# Two independent hashes make a key of 128 bits.
_SEEDS = (401, 402)


def line_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end (without blanks around) of every line with a word, and per text where its lines begin in the lists.

    The third value is followed by each line's number within its text, counting all lines.
    """
    breaks = np.flatnonzero(data == 10)
    lead = offsets[:-1]
    starts = np.sort(np.concatenate([lead, breaks + 1]), kind="stable")
    # A break at a text's last byte starts an empty line of that text: it sorts before the next text's first line.
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    owner = np.repeat(np.arange(len(lead)), np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=len(lead)) + 1)
    first_line = np.searchsorted(owner, np.arange(len(lead) + 1))
    number = np.arange(len(starts)) - first_line[owner]
    inside = np.flatnonzero(~_GAP[data])
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64), empty
    first = np.searchsorted(inside, starts)
    last = np.searchsorted(inside, ends) - 1
    full = last >= first
    first, last = inside[first[full]], inside[last[full]] + 1
    return first, last, np.searchsorted(owner[full], np.arange(len(offsets))), number[full]


def _fingerprints(text_column: pa.Array, run: int, hashers: tuple[Hasher, Hasher], passage: int | None = None) -> Iterator[list[tuple]]:
    """Per text its fingerprints: (hash, windows that chose it as (key, key, numbers of their lines))."""
    data, offsets = bytes_of(text_column)
    starts, ends, first, number = line_ranges(data, offsets)
    one, two = (h.ranges(data, starts, ends) for h in hashers)
    if passage is not None:
        begins = word_ranges(data, offsets)[0]
        # Words up to each line, from the first of the batch on; lines without a word hold none.
        words = np.append(0, np.cumsum(np.searchsorted(begins, ends) - np.searchsorted(begins, starts)))
    for a, b in zip(first[:-1], first[1:], strict=True):
        found = []
        for width in range(run if passage is None else 1, run + 1):
            n = b - a - width + 1
            if n <= 0:
                continue
            windows = np.lib.stride_tricks.sliding_window_view(one[a:b], width)
            chosen = windows.argmin(1) + np.arange(n)
            # All windows of a run; of shorter ones those with words enough, and the one that is the whole text.
            held = np.arange(n) if width == run or n == 1 else np.flatnonzero(words[a + width : b + 1] - words[a : b - width + 1] >= passage)
            if not len(held):
                continue
            keys = []
            for lines in (windows, np.lib.stride_tricks.sliding_window_view(two[a:b], width)):
                key = np.zeros(n, np.uint64)
                for k in range(width):
                    key = mix(key + lines[:, k])
                keys.append(key.view(np.int64).tolist())
            places = np.lib.stride_tricks.sliding_window_view(number[a:b], width)
            marks = one[a:b].view(np.int64)
            begin = np.flatnonzero(np.diff(chosen[held], prepend=-1))
            for s, e in zip(begin, np.append(begin[1:], len(held)), strict=True):
                found.append((int(marks[chosen[held[s]]]), [{"k1": keys[0][w], "k2": keys[1][w], "at": places[w].tolist()} for w in held[s:e].tolist()]))
        yield found


def repeated_lines(docs: DataFrame, run: int = 3, id_col: str = "doc_id", text: str = "text", passage: int | None = None) -> DataFrame:
    """(doc, hash, removed): the numbers (from 0, all lines counted) of the lines to delete, for documents that have any.

    A line is deleted if it lies in ``run`` or more consecutive lines that stood before, in order of id (null first)
    and place, in another document or the same. Lines without a word are no part of a run: they are skipped and stay.
    With ``passage`` it is also deleted if it lies in fewer consecutive lines that stood before and hold ``passage`` words
    or more together, or if its text has fewer lines with a word than ``run`` and they stood before as a whole text.
    Lines compare without blanks around them. ``doc`` and ``hash`` (xxhash64 of the text) name a document; rows alike
    in both are one document and do not repeat each other.
    """
    source = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text__"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = (Hasher(_SEEDS[0]), Hasher(_SEEDS[1]))
        windows_type = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.list_(pa.int32()))]))
        for batch in small_batches(batches, "text__", 1 << 20):
            docs_, hashes, prints, windows = [], [], [], []
            ids, own = batch.column("doc").to_pylist(), batch.column("hash").to_pylist()
            for k, found in enumerate(_fingerprints(batch.column("text__"), run, hashers, passage)):
                for mark, around in found:
                    docs_.append(ids[k])
                    hashes.append(own[k])
                    prints.append(mark)
                    windows.append(around)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, batch.schema.field("doc").type), pa.array(hashes, pa.int64()), pa.array(prints, pa.int64()), pa.array(windows, windows_type)],
                names=["doc", "hash", "print", "windows"])

    prints = materialize(
        source.mapInArrow(find, f"doc {id_type}, hash long, print long, windows array<struct<k1: long, k2: long, at: array<int>>>"), "fingerprints")
    again = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    around = prints.join(again, "print", "left_semi").select("doc", "hash", F.explode("windows").alias("w")).select("doc", "hash", "w.k1", "w.k2", "w.at")
    place = F.struct("doc", "hash", "at")
    firsts = around.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("k1", "k2", "first")
    later = around.join(firsts, ["k1", "k2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc", "hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("at")))).alias("removed"))


def drop_repeated_lines(docs: DataFrame, run: int = 3, id_col: str = "doc_id", text: str = "text", passage: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the lines of ``repeated_lines`` deleted from the text.

    Texts without such lines stay as they are, null and empty ones too; a text may become empty.
    """
    columns = docs.columns
    removed = repeated_lines(docs, run, id_col, text, passage).select(
        F.col("doc").alias("lines_id__"), F.col("hash").alias("lines_hash__"), F.col("removed").alias("lines_removed__"))
    joined = docs.withColumn("lines_own__", F.xxhash64(text)).join(
        removed, F.col(id_col).eqNullSafe(F.col("lines_id__")) & (F.col("lines_own__") == F.col("lines_hash__")), "left")
    joined = joined.select(*[F.col(c) for c in columns], "lines_removed__")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text, 4 << 20):
            at, mark = batch.schema.get_field_index(text), batch.schema.get_field_index("lines_removed__")
            arrays = [batch.column(k) for k in range(batch.num_columns) if k != mark]
            removed_lists = batch.column(mark)
            if removed_lists.null_count < batch.num_rows:
                arrays[at] = pa.array(map(_without, batch.column(at).to_pylist(), removed_lists.to_pylist()), batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return joined.mapInArrow(cut, docs.schema)


def _without(text: str | None, removed: list[int] | None) -> str | None:
    if not removed:
        return text
    gone = set(removed)
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
