"""Benchmark decontamination: pigeonhole pieces, exact piece hits, Myers bit-parallel verification.

Texts are normalised (lower case, runs of white space as one space). An item of m characters may be found
with up to ``k = floor(m * EDIT_RATE)`` edits. It is split into k + 1 pieces: k edits leave at least one
piece whole, so an automaton over all pieces finds every place worth looking at. Around such a place, Myers'
algorithm gives the least edit distance between the item and any substring.

Items come in blocks of at most ``BLOCK_CHARS`` characters, each sent to all tasks; the documents are
read once for each block and are never shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hold_cache

EDIT_RATE = 0.05
BLOCK_CHARS = 1_000_000
LEAKS = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"

_SPACE = re.compile(r"\s+")
#: Thai, Lao, Burmese, Khmer, kana and Han letters are written without spaces, so a word may end between any two
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normalise(text: str) -> str:
    return _SPACE.sub(" ", text.lower()).strip()


def inside_word(text: str, at: int) -> bool:
    """Whether a word goes on over the place before ``text[at]``."""
    if not 0 < at < len(text):
        return False
    around = text[at - 1:at + 1]
    return around[0].isalnum() and around[1].isalnum() and not _UNSPACED.search(around)


def best_match(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to a substring of ``text`` and the end of the first such, or None above ``most``."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score = full, 0, m
    best = (m, 0) if m <= most else None  # the empty substring
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


def _merged(windows: list[list[int]]) -> list[list[int]]:
    """Windows that overlap as one, in ascending order."""
    out: list[list[int]] = []
    for lo, hi in sorted(windows):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return out


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], edit_rate: float = EDIT_RATE):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalise(text or "")
            if not text:
                continue
            k = int(len(text) * edit_rate)
            at = len(self.items)
            self.items.append((item_id, text, k))
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for lo, hi in zip(cuts, cuts[1:]):
                pieces.setdefault(text[lo:hi], []).append((at, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            # a piece that an item repeats: its first and its last place there bound all windows between
            spans: dict[int, tuple[int, int]] = {}
            for at, offset in places:
                lo, hi = spans.get(at, (offset, offset))
                spans[at] = (min(lo, offset), max(hi, offset))
            self.automaton.add_word(piece, (len(piece), [(at, lo, hi) for at, (lo, hi) in spans.items()]))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def find(self, text: str | None) -> list[dict]:
        """Items within their error budget, each with its best match; places are in the normalised text."""
        if self.empty or not text:
            return []
        text = normalise(text)
        best: dict[int, tuple[int, int, int]] = {}
        windows: dict[int, list[list[int]]] = {}  # those of one item that overlap are one, so each stretch is searched once
        for end, (length, places) in self.automaton.iter(text):
            start = end - length + 1
            for at, first, last in places:
                _, item, k = self.items[at]
                if k == 0:  # the piece is the whole item
                    if at not in best and not inside_word(text, start) and not inside_word(text, end + 1):
                        best[at] = (0, start, end + 1)
                    continue
                lo, hi = max(0, start - last - k), start - first + len(item) + k
                known = windows.setdefault(at, [])
                if known and known[-1][0] <= hi and lo <= known[-1][1]:
                    known[-1][0], known[-1][1] = min(lo, known[-1][0]), max(hi, known[-1][1])
                else:
                    known.append([lo, hi])
        for at, known in windows.items():
            _, item, k = self.items[at]
            for lo, hi in _merged(known):
                found = best_match(item, text[lo:hi], k if at not in best else best[at][0] - 1)
                if found:
                    stop = lo + found[1]
                    back = best_match(item[::-1], text[max(0, stop - len(item) - k):stop][::-1], found[0])
                    best[at] = (found[0], stop - back[1], stop)
                    if not found[0]:
                        break
        return [{"item_id": self.items[at][0], "distance": d, "start": s, "end": e} for at, (d, s, e) in sorted(best.items())]


_finders: dict[str, Finder] = {}  # of the block this Python worker used last


def leaks(text: Column, items: DataFrame, id_col: str = "item_id", text_col: str = "text", edit_rate: float = EDIT_RATE) -> Column:
    """Array of (item_id, distance, start, end) of the benchmark items found in each text.

    Null or empty texts and items match nothing. Items that repeat a text are reported each; repeated rows
    with one id and one text count once. An item shorter than ``1 / edit_rate`` characters has to be found
    exactly and not inside a longer word ('yes' isn't in 'yesterday'). An empty benchmark gives empty arrays.
    """
    known = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).distinct()
    chars = known.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * chars // BLOCK_CHARS))
    sc = items.sparkSession.sparkContext
    found = None
    for b in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        column = _finder_column(sc.broadcast([(r["i"], r["t"]) for r in rows]), edit_rate)(text)
        found = column if found is None else F.concat(found, column)
    return found


def _finder_column(block, edit_rate: float):
    name = uuid.uuid4().hex

    @F.pandas_udf(LEAKS)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold_cache("decontaminate", _finders.clear)
        finder = _finders.get(name)
        if finder is None:
            _finders.clear()
            finder = _finders[name] = Finder(block.value, edit_rate)
        for texts in parts:
            yield pd.Series([finder.find(t) for t in texts], dtype=object)
    return find.asNondeterministic()  # or a filter on the result would run it a second time


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit_rate: float = EDIT_RATE) -> DataFrame:
    """One row per document row and benchmark item found in it: doc_id, item_id, distance, start, end."""
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), leaks(F.col(text_col), items, edit_rate=edit_rate).alias("leaks"))
    return found.select("doc_id", F.inline("leaks"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", edit_rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns."""
    return docs.where(F.size(leaks(F.col(text_col), items, edit_rate=edit_rate)) == 0)
