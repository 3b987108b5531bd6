"""Fill-in-middle transformation: texts cut at unit boundaries and put in another order, whole and reversible.

Units are ``[A-Za-z]+|[^A-Za-z]`` over code points. A batch of texts is looked at as its UTF-8 bytes. Its sparse
exception index holds the multibyte characters only: the byte place of each and the bytes it has beyond one, summed
up. ``np.searchsorted`` in it turns byte cuts into code-point cuts and back; between two exceptions a cut is plain
arithmetic, so ASCII texts have an empty index and no conversion. Texts are read in slices of bounded size and
never shuffled.

Cuts and form follow from the digest of ``1:`` and the document id, so a repeated run gives the same rows.

Defined results: null and empty texts are ``plain`` with an empty output and no units; a null doc_id is written as
``null`` in the digest; repeated rows have a row each; texts that hold a marker are ``plain``; an empty table gives
an empty one; columns other than the id and the text are not read, so their names cannot clash. A text over the
size of a slice is a slice of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
SLICE_BYTES = 8 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class ExceptionIndex:
    """Where the multibyte characters of UTF-8 bytes are and how many bytes they have beyond one."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        self.excess = np.zeros(len(self.at) + 1, np.int64)
        np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), out=self.excess[1:])
        self.points = self.at - self.excess[:-1]

    def to_points(self, byte: np.ndarray) -> np.ndarray:
        """Code points before each byte cut."""
        return byte - self.excess[np.searchsorted(self.at, byte)] if len(self.at) else byte

    def to_bytes(self, point: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return point + self.excess[np.searchsorted(self.points, point)] if len(self.at) else point


def unit_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Byte places where units begin, in bytes that hold texts end to end; ``texts`` are the beginnings of those not empty."""
    letter = _LETTER[data]
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[texts] = True
    return np.flatnonzero(starts)


def _numbers(doc_id) -> list[int]:
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


def _slices(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, bytes and text ends of runs of rows with about ``SLICE_BYTES`` of text."""
    for b in it:
        texts = b.column(1).cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE_BYTES, "right")) - 1)
            size = int(ends[hi] - ends[lo])
            raw = np.frombuffer(data, np.uint8, size, int(ends[lo])) if size else np.zeros(0, np.uint8)
            yield b.column(0).slice(lo, hi - lo), raw, ends[lo:hi + 1] - ends[lo]
            lo = hi


def _transform(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, ends in _slices(it):
        index, starts = ExceptionIndex(data), unit_starts(data, ends[:-1][np.diff(ends) > 0])
        first = np.searchsorted(starts, ends)
        n = np.diff(first)
        drawn = [_numbers(i) for i in ids.to_pylist()]
        h1, h2 = (np.array([d[k] for d in drawn], np.int64) % (n + 1) for k in (0, 1))
        cuts = np.stack([np.minimum(h1, h2), np.maximum(h1, h2)]) + first[:-1]
        # the cut after the last unit of a text is its end, where the next text's first unit begins
        places = np.append(starts, len(data))[cuts]
        points = index.to_points(np.vstack([ends[:-1], places]).ravel()).reshape(3, -1)
        raw = data.tobytes()
        forms, outs, prefix, middle = [], [], [], []
        for k, (_, _, h3, h4) in enumerate(drawn):
            a, p, m, z = int(ends[k]), int(places[0, k]), int(places[1, k]), int(ends[k + 1])
            text = raw[a:z]
            if not text or h3 % 100 >= PLAIN_FROM or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                forms.append("plain")
                outs.append(text)
                prefix.append(None)
                middle.append(None)
                continue
            spm = h4 % 100 < SPM_BELOW
            forms.append("spm" if spm else "psm")
            pre, mid, suf = raw[a:p], raw[p:m], raw[m:z]
            outs.append(b"".join((SUFFIX, suf, PREFIX, pre, MIDDLE, mid) if spm else (PREFIX, pre, SUFFIX, suf, MIDDLE, mid)))
            prefix.append(int(points[1, k] - points[0, k]))
            middle.append(int(points[2, k] - points[1, k]))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
             pa.array(outs, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row: its units, its form and the whole text in that form."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_transform, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, form string, "
                                       "prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone. The three parts hold no marker, and none can arise where they meet one."""
    part = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(part[1], part[3], part[2]))
            .otherwise(F.concat(part[2], part[3], part[1])))
