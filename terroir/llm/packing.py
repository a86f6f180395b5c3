"""Sum-of-squares packing of tokenised documents into windows of a fixed length.

A window's level is how many tokens it holds. The next piece goes to the level (0 is a new window) that leaves the
smallest sum of squared counts of partially filled windows; an array of counts per level is all the rule looks at.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TAIL = "#*$%&.,!?:;|<>-"  # ASCII signs the tokenizer always parts from a letter or digit before them


class TokenCache(dict):
    """Token ids (little-endian unsigned 32-bit bytes) of blank-free stretches of text.

    The tokenizer starts anew after white space, so a text's ids are those of its stretches in order. Unknown words of
    letters are encoded many at a time: each is one unit to the tokenizer, whose last token is one that ends words.
    At ``limit`` stretches the cache starts over.
    """

    def __init__(self, tokenizer, limit: int = 1_000_000):
        super().__init__()
        self.tokenizer, self.limit = tokenizer, limit
        names = tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[k for name, k in names.items() if name.endswith("</w>")]] = True

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [_folded(t or "").replace("\n", " ").split(" ") for t in texts]
        if len(self) > self.limit:
            self.clear()
        self[""] = b""
        known = [list(map(self.get, words)) for words in split]
        gaps = [list(compress(range(len(parts)), map(not_, parts))) for parts in known]
        missing: set[str] = set()
        for words, at in zip(split, gaps, strict=True):
            missing.update(map(words.__getitem__, at))
        missing.discard("")
        self._learn(missing)
        for words, parts, at in zip(split, known, gaps, strict=True):
            for k in at:
                parts[k] = self[words[k]]
        return [b"".join(parts) for parts in known]

    def _learn(self, missing: set[str]) -> None:
        bodies, others, tailed = [], set(), []
        new: set[str] = set()
        for word in missing:
            body = word.rstrip(_TAIL)
            if not _is_word(body):
                others.add(word)
            elif len(body) == len(word):
                bodies.append(word)
            else:
                tailed.append(word)
                if body not in self and body not in missing:
                    new.add(body)
                tail = word[len(body):]
                if tail not in self:
                    others.add(tail)
        self._learn_words(bodies + list(new))
        others = list(others)
        for piece, found in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self[piece] = np.array(found.ids, "<u4").tobytes()
        for word in tailed:
            body = word.rstrip(_TAIL)
            self[word] = self[body] + self[word[len(body):]]

    def _learn_words(self, words: list[str], together: int = 500) -> None:
        groups = [words[k : k + together] for k in range(0, len(words), together)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) != len(group):
                raise ValueError("the tokenizer does not end each word with an end token")
            data, start = ids.tobytes(), 0
            for word, end in zip(group, cuts.tolist(), strict=True):
                self[word] = data[start:end]
                start = end


def _folded(text: str) -> str:
    """Lower case where that surely is what the tokenizer does first: texts of Latin-1 letters, without special tokens."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def _is_word(body: str) -> bool:
    """Letters only, and still so when normalised and lower-cased: one unit to the tokenizer."""
    return body.isalpha() and (body.isascii() or unicodedata.normalize("NFC", body).lower().isalpha())


class Packer:
    """Places pieces of at most ``size`` tokens online; ``finish`` closes what is still partly filled."""

    def __init__(self, size: int, prefix: int):
        self.size, self.next_id = size, prefix
        self.counts = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[tuple[int, list]]] = {}  # by level: windows as (id, pieces)
        self.rows: list[tuple] = []

    def add(self, doc: int, ids: bytes) -> None:
        """A document's ids: full windows first, the rest by the sum of squares."""
        total, size = len(ids) // 4, self.size
        whole = total - total % size
        for start in range(0, whole, size):
            self._write(self._new(), [(doc, start, total, ids[4 * start : 4 * (start + size)])])
        if whole < total:
            self._place((doc, whole, total, ids[4 * whole :]))

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _place(self, piece: tuple) -> None:
        length, size = len(piece[3]) // 4, self.size
        levels = np.append(0, np.flatnonzero(self.counts))
        levels = levels[levels + length <= size]
        # Squares change by 1 - 2 N(level) where a window leaves a level and by 1 + 2 N(level) where it arrives;
        # level 0 and the full level do not count.
        change = np.where(levels > 0, 1 - 2 * self.counts[levels], 0)
        change = change + np.where(levels + length < size, 1 + 2 * self.counts[levels + length], 0)
        level = int(levels[len(levels) - 1 - np.argmin(change[::-1])])  # ties: the fullest window
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        else:
            window = (self._new(), [])
        window[1].append(piece)
        if level + length == size:
            self._write(*window)
        else:
            self.open.setdefault(level + length, []).append(window)
            self.counts[level + length] += 1

    def _write(self, sequence: int, pieces: list) -> None:
        offset = 0
        for doc, start, total, ids in pieces:
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset))
            offset += len(ids) // 4

    def finish(self) -> None:
        """Pour the open windows together, cutting pieces at window ends; the last rest becomes powers of two."""
        pieces = [p for level in sorted(self.open, reverse=True) for _, held in self.open[level] for p in held]
        left = sum(len(p[3]) // 4 for p in pieces)
        room, held = 0, []
        for doc, start, total, ids in pieces:
            while ids:
                if not room:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                take = min(room, len(ids) // 4)
                held.append((doc, start, total, ids[: 4 * take]))
                ids, start, room, left = ids[4 * take :], start + take, room - take, left - take
                if not room:
                    self._write(self._new(), held)
                    held = []
        self.open, self.counts[:] = {}, 0


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: the id column, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    Every task packs the rows of its own partition, so nothing is shuffled and a lost task packs them again alike;
    memory is one level array and the windows open at a time. What stays open at the end of a partition is cut into
    full windows and at most log2(size) shorter ones, whose lengths are powers of two. ``size`` should be one.
    Null and empty texts are documents of the end id alone; null ids and repeated rows are packed like others.
    ``tokenizer_path`` must be readable on the workers. Only the two named columns are read.
    """
    source = docs.select(F.col(id_col).alias("id__"), F.col(text).alias("text__"))
    end = int(end_id).to_bytes(4, "little")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        cache = TokenCache(Tokenizer.from_file(tokenizer_path))
        packer = Packer(size, TaskContext.get().partitionId() << 32)

        def out(id_arrow: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [()] * 7
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_arrow)] + [pa.array(c, pa.int64()) for c in columns[1:]],
                names=["id__", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        kind = None
        for batch in small_batches(batches, "text__", 1 << 20):
            kind = batch.schema.field("id__").type
            for doc, ids in zip(batch.column("id__").to_pylist(), cache.encode(batch.column("text__").to_pylist()), strict=True):
                packer.add(doc, ids + end)
            if packer.rows:
                yield out(kind)
        packer.finish()
        if packer.rows:
            yield out(kind)

    return source.mapInArrow(run, f"id__ {id_type}, {SCHEMA}").withColumnRenamed("id__", id_col)
