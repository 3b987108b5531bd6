"""Token counts by a linear longest-match automaton.

The vocabulary has pieces that begin a word and pieces that continue one. Both go into one trie with two
roots; the bare word-begin mark, if it is a piece, leads from the first root to the second. When no piece goes on with the next character, a failure link leads to the place that the automaton
would have after cutting off the longest pieces, and the link's count says how many pieces that were. A
word is counted in one pass over its characters, and no piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, hold_cache

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
WORD_BEGIN = "▁"
CACHE_ENTRIES = 300_000
CACHED_CHARS = 64

BEGIN, CONTINUE = 0, 1
UNKNOWN = -1


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_VOCABULARY)


def load_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word (without the mark, so the bare mark is empty) and pieces that continue one, from a sentencepiece model."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    begin, go_on = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if piece.startswith(WORD_BEGIN):
            begin.append(piece[1:])
        else:
            go_on.append(piece)
    return begin, go_on


class Counter:
    """The automaton over a vocabulary."""

    def __init__(self, begin: Iterable[str], go_on: Iterable[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        ends, bare = set(), False
        for root, pieces in ((BEGIN, begin), (CONTINUE, go_on)):
            for piece in pieces:
                node = root
                bare |= root == BEGIN and not piece
                for c in piece:
                    node = self.children[node].setdefault(c, len(self.children))
                    if node == len(self.children):
                        self.children.append({})
                if node != root:
                    ends.add(node)
        self.fail = [-1] * len(self.children)  # -1: no way on, the word is unknown
        self.popped = [0] * len(self.children)
        if bare:  # the word-begin mark is a piece itself: any word may go on after it
            self.fail[BEGIN], self.popped[BEGIN] = CONTINUE, 1
        queue = deque([BEGIN, CONTINUE])
        while queue:
            parent = queue.popleft()
            for c, node in self.children[parent].items():
                queue.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = CONTINUE, 1
                    continue
                at, n = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.children[at]:
                    n += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.children[at][c], n
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of the greedy longest-match cut of a word, or UNKNOWN if there is none."""
        children, fail, popped = self.children, self.fail, self.popped
        node, n = BEGIN, 0
        for c in word:
            while c not in children[node]:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return UNKNOWN
            node = children[node][c]
        while node != CONTINUE:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return UNKNOWN
        return n

    def text(self, text: str) -> tuple[int, int, int]:
        """Words, tokens and unknown words of a text; an unknown word is one token."""
        words = text.split()
        cache, unknown, tokens = self.cache, 0, 0
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for w in words:
            n = cache.get(w)
            if n is None:
                n = self.word(w)
                if len(w) <= CACHED_CHARS:
                    cache[w] = n
            if n == UNKNOWN:
                unknown += 1
                n = 1
            tokens += n
        return len(words), tokens, unknown


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The automaton of this Python worker for a vocabulary file; kept between tasks."""
    hold_cache("token_counts", _counters.clear)
    if path not in _counters:
        _counters[path] = Counter(*load_vocabulary(path))
    return _counters[path]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_tokens, n_unknown of the whole text.

    Words stand between white space. Null and empty texts count 0; a null id stays null; repeated rows are
    counted each; other columns are ignored. One pass over the texts, no shuffle.
    """
    path = vocabulary or default_vocabulary()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).text
        for b in batches(it):
            rows = [count(t or "") for t in b.column(1).to_pylist()]
            words, tokens, unknown = zip(*rows)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_words": pa.array(words, pa.int64()),
                                              "n_tokens": pa.array(tokens, pa.int64()), "n_unknown": pa.array(unknown, pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
