"""Fill-in-the-middle transformation of documents, and its inverse.

Two cuts, drawn by a hash of the id, part a text into prefix, middle and suffix;
the parts are written with a mark before each, the middle last. Cuts fall
between units (lines or code points). A text lies in UTF-8, where code points and
bytes differ only by what its multibyte characters have in excess, so the index
that converts one into the other records those characters alone: a cut is found
by a binary search among them, and ASCII stretches stay plain arithmetic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import derive_columns

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Drawn cuts, share of documents to transform and share of those with the suffix first, in percent.
SEED, TRANSFORMED, SUFFIX_FIRST = 7, 100, 50
PLAIN, PSM, SPM = "plain", "psm", "spm"

_EXCESS = np.zeros(256, np.int8)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:] = 1, 2, 3


class ExceptionIndex:
    """Code points and bytes of UTF-8 data, by its multibyte characters: their places, and the bytes in excess up to each."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        self.excess = np.concatenate(([0], np.cumsum(_EXCESS[data[self.at]], dtype=np.int64)))
        self.char_at = self.at - self.excess[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before a byte offset that is a character's first byte (or the end)."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Byte offset of a code point."""
        return char + self.excess[np.searchsorted(self.char_at, char)]


def line_cuts(data: np.ndarray, offsets: np.ndarray):
    """Number of lines of each text, and a function from a number of lines to the byte offset behind them."""
    begin, end = offsets[:-1], offsets[1:]
    breaks = np.flatnonzero(data == 0x0A)
    first = np.searchsorted(breaks, begin)
    n = np.searchsorted(breaks, end) - first
    open_end = np.zeros(len(n), bool)
    some = end > begin
    open_end[some] = data[end[some] - 1] != 0x0A
    n += open_end

    def byte(units: np.ndarray) -> np.ndarray:
        inner = (units > 0) & (units < n)
        out = np.where(units > 0, end, begin)
        out[inner] = breaks[(first + units - 1)[inner]] + 1
        return out

    return n, byte


def char_cuts(data: np.ndarray, offsets: np.ndarray, index: ExceptionIndex):
    """Number of code points of each text, and a function from a number of them to the byte offset behind them."""
    start = index.chars(offsets)
    return np.diff(start), lambda units: index.bytes(start[:-1] + units)


def _transform(unit: str, transformed: int, suffix_first: int, marks: tuple[str, str, str]):
    p, s, m = (x.encode() for x in marks)

    def run(data: np.ndarray, offsets: np.ndarray, *drawn: pa.Array) -> list:
        h1, h2, h3, h4 = (x.to_numpy(zero_copy_only=False) for x in drawn)
        index = ExceptionIndex(data)
        n, byte = line_cuts(data, offsets) if unit == "line" else char_cuts(data, offsets, index)
        a, b = h1 % (n + 1), h2 % (n + 1)
        cuts = np.stack([offsets[:-1], byte(np.minimum(a, b)), byte(np.maximum(a, b)), offsets[1:]])
        chars = np.diff(index.chars(cuts), axis=0)
        raw = data.tobytes()
        form, output = [], []
        for k, (w, x, y, z) in enumerate(cuts.T.tolist()):
            text = raw[w:z]
            if not text or h3[k] % 100 >= transformed or p in text or s in text or m in text:
                form.append(PLAIN)
                output.append(text)
            elif h4[k] % 100 < suffix_first:
                form.append(SPM)
                output.append(b"".join((s, raw[y:z], p, raw[w:x], m, raw[x:y])))
            else:
                form.append(PSM)
                output.append(b"".join((p, raw[w:x], s, raw[y:z], m, raw[x:y])))
        plain = np.array([f == PLAIN for f in form], bool)
        return [pa.array(n.astype(np.int64)), form, pa.array(chars[0], mask=plain), pa.array(chars[1], mask=plain), pa.array(output, pa.binary()).cast(pa.string())]

    return run


def fill_in_middle(
    documents: DataFrame,
    keep: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    unit: str = "line",
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """``keep`` columns and n (units), form, prefix_chars, middle_chars (code points), output (text).

    The first four 8-digit groups of the hex sha256 of ``seed:doc_id`` draw both
    cuts, whether to transform and the order of the parts. Form is ``plain`` (the
    output is the text, both lengths are null) if the text is null or empty, holds
    one of the marks or isn't drawn; else ``psm`` or ``spm``. ``unit`` is "line"
    (with its line feed) or "char" (a code point). A null id counts as an empty
    one. Rows that repeat a doc_id get the same draw. An empty table gives no rows.
    A kept column with the name of a made one is left out. A long text is handled
    alone; besides itself and its output, 17 bytes for each of its lines and
    multibyte characters are held.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), 256)
    drawn = tuple(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    made = "n long, form string, prefix_chars long, middle_chars long, output string"
    return derive_columns(documents, text, keep, made, lambda: _transform(unit, transformed, suffix_first, marks), drawn)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text behind an output of ``fill_in_middle``, exactly: no part holds a mark, so the marks part it."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
