"""Fill-in-the-middle: a text cut at two unit borders into prefix, middle and suffix, the middle moved to the end.

A text's units are its lines, ``[^\\n]*\\n|[^\\n]+`` matched left to right over code points. One full match of the
repeated unit with the ``regex`` library keeps every repetition of its group, so ``match.ends(1)`` gives at once the
number of units and the offset at which each one ends; the two cuts are looked up there, without a loop over lines.

Where each text is cut, and in which of the two orders it is written, comes from the sha256 of ``<tag>:<id>``: its
first four groups of eight hex digits, h1 to h4. The cuts lie after min and max of h1 and h2 modulo (units + 1);
the form is plain when the text is empty or holds a marker, or when h3 % 100 >= ``rate``; else spm when
h4 % 100 < ``spm_rate``, else psm.

Defined results: a null text is empty (0 units, plain); a null id gives plain, for it has no hash; repeated rows get
equal results; long texts are whole (units are found in linear time, in the task of their row); an empty table gives
an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# The sentinels of prefix, suffix and middle, and the unit of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[^\\n]*\\n|[^\\n]+"

_REPEATED = regex.compile(f"({UNIT})*")


def unit_ends(text: str) -> list[int]:
    """Offsets (code points) at which the units of a text end, from one full match of the repeated unit."""
    return _REPEATED.fullmatch(text).ends(1)


def hash_groups(doc_id: int, tag: str = "7") -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{tag}:{doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def split(text: str | None, doc_id: int | None, tag: str = "7", rate: int = 100, spm_rate: int = 50) -> tuple[int, str, str, str, str]:
    """(units, form, prefix, middle, suffix) of one text; plain forms have the whole text as prefix."""
    text = text or ""
    ends = unit_ends(text)
    n = len(ends)
    if doc_id is None or not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", text, "", ""
    h1, h2, h3, h4 = hash_groups(doc_id, tag)
    if h3 % 100 >= rate:
        return n, "plain", text, "", ""
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut1, cut2 = (ends[low - 1] if low else 0), (ends[high - 1] if high else 0)
    return n, "spm" if h4 % 100 < spm_rate else "psm", text[:cut1], text[cut1:cut2], text[cut2:]


def write(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    if form == "spm":
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return prefix


def fill_in_middle(docs: DataFrame, text: str = "text", id_col: str = "doc_id", tag: str = "7", rate: int = 100,
                   spm_rate: int = 50) -> DataFrame:
    """Per row: the id, n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain)
    and output, the text as written for training."""
    source = docs.select(F.col(id_col).cast("long").alias("id__"), F.col(text).alias("text__"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text__", 4 << 20, 1024):
            n, form, prefix_chars, middle_chars, output = [], [], [], [], []
            for doc_id, body in zip(batch.column("id__").to_pylist(), batch.column("text__").to_pylist(), strict=True):
                units, kind, prefix, middle, suffix = split(body, doc_id, tag, rate, spm_rate)
                n.append(units)
                form.append(kind)
                prefix_chars.append(None if kind == "plain" else len(prefix))
                middle_chars.append(None if kind == "plain" else len(middle))
                output.append(write(kind, prefix, middle, suffix))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id__"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix_chars, pa.int64()),
                 pa.array(middle_chars, pa.int64()), pa.array(output, pa.large_string()).cast(pa.string())],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = f"`{id_col}` long, n long, form string, prefix_chars long, middle_chars long, output string"
    return source.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The original text from a written one, by column expressions: the markers are found once each, in order."""
    at_p, at_s, at_m = (F.locate(m, output) for m in (PREFIX, SUFFIX, MIDDLE))
    width = len(PREFIX)

    def between(start: Column, end: Column) -> Column:
        return output.substr(start + width, end - start - width)

    rest = output.substr(at_m + width, F.lit(2**31 - 1))
    return (F.when(form == "psm", F.concat(between(at_p, at_s), rest, between(at_s, at_m)))
            .when(form == "spm", F.concat(between(at_p, at_m), rest, between(at_s, at_p)))
            .otherwise(output))
