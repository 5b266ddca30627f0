"""Cells of delimited lines, cleaned in Arrow batches.

Wide lines hold many times more cells than lines: what is done to every cell by itself costs more than all else of a load. Here lines are cut, trimmed and held
against the null tokens by comparisons of whole columns of bytes. It gives what split_cells and clean_text give; whatever is not plain is left to the parsers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsieve.functions.text import whitespace
from loadsieve.sources.grid import split_cells

# the executors need not have this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Name of the value of a plain number, null for every other text.
PLAIN = "__plain_"

# Lines that are cut at once.
SLICE = 4096

_WHITE = whitespace()


def _table(codes: Sequence[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(codes)] = True
    return table


_DIGIT = _table(range(ord("0"), ord("9") + 1))
_DOT = _table(b".")
# bytes that a white space may begin or end with; whether it does is seen in the text
_FIRST, _LAST = _table([w.encode()[0] for w in _WHITE]), _table([w.encode()[-1] for w in _WHITE])
# the white space of one byte
_SPACE = _table([ord(w) for w in _WHITE if w.isascii()])


def cut(data: np.ndarray, lows: np.ndarray, highs: np.ndarray, delimiter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every cell of lines that lie one after the other, line by line, and the first cell of every line."""
    a, b = (int(lows[0]), int(highs[-1])) if len(lows) else (0, 0)
    found = np.flatnonzero(data[a:b] == delimiter) + a
    # every line has a cell more than delimiters
    before = np.searchsorted(found, lows)
    firsts = before + np.arange(len(lows))
    counts = np.searchsorted(found, highs) - before + 1
    starts, ends = np.empty(len(found) + len(lows), dtype=np.int64), np.empty(len(found) + len(lows), dtype=np.int64)
    inner = np.ones(len(starts), dtype=bool)
    inner[firsts] = False
    starts[firsts], starts[inner] = lows, found + 1
    inner[:] = True
    lasts = firsts + counts - 1
    inner[lasts] = False
    ends[lasts], ends[inner] = highs, found
    return starts, ends, firsts


def trim(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Move the ends of cells to their first and behind their last character that is no white space."""
    for table, bound, step, at in ((_FIRST, starts, 1, lambda i: data[starts[i]]), (_LAST, ends, -1, lambda i: data[ends[i] - 1])):
        left = np.flatnonzero(ends > starts)
        left = left[table[at(left)]]
        while len(left):
            one = left[_SPACE[at(left)]]
            # a white space of several bytes is rare, so are characters that share its outer byte
            for i in left[~_SPACE[at(left)]].tolist():
                text = data[starts[i] : ends[i]].tobytes().decode()
                kept = text.lstrip(_WHITE) if step > 0 else text.rstrip(_WHITE)
                bound[i] += step * (len(text.encode()) - len(kept.encode()))
            bound[one] += step
            one = one[ends[one] > starts[one]]
            left = one[table[at(one)]]


def is_token(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tokens: Sequence[str]) -> np.ndarray:
    """Whether a cell is one of the tokens."""
    sizes, out = ends - starts, np.zeros(len(starts), dtype=bool)
    coded = sorted({t.encode() for t in tokens}, key=len)
    short = np.flatnonzero(sizes <= len(coded[-1]))
    for token in coded:
        at = short[sizes[short] == len(token)]
        for i, byte in enumerate(token):
            at = at[data[starts[at] + i] == byte]
        out[at] = True
    return out


def is_plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a cell is digits with a point at most, perhaps after a minus: such text is the same number to every parser."""
    if not len(starts):
        return np.zeros(0, dtype=bool)
    sizes = ends - starts
    # no more than 18 bytes are looked at, as longer numbers are rare
    out = (sizes > 0) & (sizes <= 18)
    digits, dots = np.zeros(len(starts), dtype=np.int8), np.zeros(len(starts), dtype=np.int8)
    minus = np.zeros(len(starts), dtype=np.int8)
    at = np.flatnonzero(out)
    minus[at] = data[starts[at]] == ord("-")
    for i in range(int(sizes[at].max()) if len(at) else 0):
        if i:
            at = at[sizes[at] > i]
        byte = data[starts[at] + i]
        digits[at] += _DIGIT[byte]
        dots[at] += _DOT[byte]
    return out & (digits > 0) & (dots <= 1) & (digits + dots + minus == sizes)


def _buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    """Offsets and bytes of an array of texts without nulls."""
    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32, count=len(text) + 1, offset=4 * text.offset)
    data = data if data is not None else pa.py_buffer(b"")
    return bounds, np.frombuffer(data, dtype=np.uint8), data


class Cleaner:
    """Cleans the cells of lines of one layout; `numbers` are the positions whose plain numbers are read."""

    def __init__(self, delimiter: str, tokens: Sequence[str], numbers: Sequence[int]) -> None:
        self.delimiter, self.tokens, self.numbers = ord(delimiter), tuple(tokens), set(numbers)

    def __call__(self, lines: pa.Array, layout: Sequence[int | None]) -> tuple[np.ndarray, list[pa.Array], list[pa.Array]]:
        """Which lines are kept (those with a cell that says something, or all where nothing is laid out), their cells in order of the layout, and the plain numbers."""
        bounds, data, buffer = _buffers(lines)
        starts, ends, firsts = cut(data, bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64), self.delimiter)
        counts = np.diff(np.append(firsts, len(starts)))
        # only the cells that are laid out are looked at
        places = sorted({p - 1 for p in layout if p is not None})
        width = len(places)
        index = firsts[:, None] + np.array(places, dtype=np.int64)[None, :]
        there = counts[:, None] > np.array(places, dtype=np.int64)[None, :]
        # what a line lacks stands at its first cell, so that places go on growing with the lines
        index = np.where(there, index, firsts[:, None]).ravel()
        there = there.ravel()
        starts, ends = starts[index], ends[index]
        trim(data, starts, ends)
        there &= ~is_token(data, starts, ends, self.tokens)
        there = there.reshape(len(lines), width)
        kept = there.any(axis=1) if width else np.ones(len(lines), dtype=bool)
        rows = np.flatnonzero(kept)
        starts, ends = starts.reshape(len(lines), width), ends.reshape(len(lines), width)
        column = {p: i for i, p in enumerate(places)}
        cells, numbers = [], []
        for i, p in enumerate(layout):
            if p is None:
                cells.append(pa.nulls(len(rows), pa.string()))
                if i in self.numbers:
                    numbers.append(pa.nulls(len(rows), pa.float64()))
                continue
            at = column[p - 1]
            s, e, ok = starts[rows, at], ends[rows, at], there[rows, at]
            cells.append(_texts(buffer, s, e, ok))
            if i in self.numbers:
                plain = ok.copy()
                plain[ok] = is_plain(data, s[ok], e[ok])
                numbers.append(cells[-1].filter(pa.array(plain)).cast(pa.float64()) if plain.all() else _spread(cells[-1], plain))
        return kept, cells, numbers


def _texts(buffer: pa.Buffer, starts: np.ndarray, ends: np.ndarray, valid: np.ndarray) -> pa.Array:
    """The texts between some bytes, null where not valid."""
    # texts and what lies between them take turns, as the offsets of an array leave nothing out
    offsets = np.empty(2 * len(starts) + 1, dtype=np.int32)
    offsets[0:-1:2], offsets[1::2] = starts, ends
    offsets[-1] = offsets[-2] if len(starts) else 0
    turns = pa.Array.from_buffers(pa.string(), 2 * len(starts), [None, pa.py_buffer(offsets), buffer])
    return turns.take(pa.array(np.arange(0, 2 * len(starts), 2, dtype=np.int32), mask=~valid))


def _spread(texts: pa.Array, plain: np.ndarray) -> pa.Array:
    """The numbers of the plain texts in their places, null elsewhere."""
    values = np.zeros(len(texts))
    values[plain] = texts.filter(pa.array(plain)).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return pa.array(values, mask=~plain)


def clean_cells(lines: DataFrame, names: Sequence[str], numbers: Sequence[str], layout: str, delimiter: str, tokens: Sequence[str], carry: bool) -> DataFrame:
    """Lines (file, row_no, layout, line) as cleaned texts under `names`, without empty rows, and the values of plain numbers of the columns `numbers`.

    The layout of a line's file holds the cell position of every name, from 1. The layout itself is kept with `carry`.
    """
    kinds = [("file", pa.string()), ("row_no", pa.int64()), *([(layout, pa.list_(pa.int32()))] if carry else [])]
    kinds += [(n, pa.string()) for n in names] + [(PLAIN + n, pa.float64()) for n in numbers]
    arrow = pa.schema(kinds)
    clean = Cleaner(delimiter, tokens, [names.index(n) for n in numbers])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = {0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), *range(0, len(codes), SLICE), len(codes)}
            at = sorted(cuts)
            for a, b in zip(at, at[1:]):
                files, row_no, layouts, text = batch.slice(a, b - a).columns
                kept, cells, plain = clean(text.cast(pa.string()), layouts[0].as_py())
                some = pa.array(kept)
                rides = [x.filter(some) for x in (files, row_no, *([layouts] if carry else []))]
                yield pa.RecordBatch.from_arrays([x.cast(k) for x, (_, k) in zip(rides, kinds)] + cells + plain, schema=arrow)

    fields = [T.StructField("file", T.StringType()), T.StructField("row_no", T.LongType())]
    fields += [T.StructField(layout, T.ArrayType(T.IntegerType()))] if carry else []
    fields += [T.StructField(n, T.StringType()) for n in names] + [T.StructField(PLAIN + n, T.DoubleType()) for n in numbers]
    # bytes that are no text become what the cutting of lines by Spark makes of them
    whole = F.when(F.is_valid_utf8("line"), F.col("line")).otherwise(F.concat_ws(delimiter, split_cells(F.col("line"), delimiter)))
    return lines.select("file", "row_no", layout, whole.alias("line")).mapInArrow(cleaned, T.StructType(fields))
