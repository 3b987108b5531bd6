"""Byte-pair token ids of whole texts; the library is asked once per distinct word and Python worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import found_at, gathered, hold_cache
from .words import Cut, default_pattern

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
CACHE_ENTRIES = 1_500_000
CACHE_BYTES = 64 << 20
SLICE_BYTES = 4 << 20

_encoders: dict[str, "TextEncoder"] = {}


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_VOCABULARY)


def encoder(path: str) -> "TextEncoder":
    """The encoder of this Python worker for a vocabulary file; kept between tasks."""
    hold_cache("tokens", _encoders.clear)
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


class TextEncoder:
    """Ids of the tokenizers library, asked once for each distinct word.

    Words are those of the byte-level pattern: the library cuts a text at the same places and encodes each word by
    itself, so ids can be put together word by word (a word that the library cuts further gives the same ids too). A
    text with the string of an added token is encoded whole. Words and ids are kept in arrays, and forgotten when there
    are over ``CACHE_ENTRIES`` or ``CACHE_BYTES``, which changes the time only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern = default_pattern()
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.values, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > CACHE_ENTRIES or self.known.nbytes > CACHE_BYTES:
            self._forget()
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        if not len(texts):
            return []
        whole = pa.array(np.zeros(len(texts), bool))
        for a in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, a))
        found = Cut(self.pattern, pc.if_else(whole, "", texts) if whole.true_count else texts)
        place = found_at(found.words, self.known)
        new = place < 0
        if new.any():
            fresh = found.words.filter(pa.array(new))
            place[new] = np.arange(len(self.known), len(self.known) + len(fresh))
            self._learn(fresh)
        starts = (np.cumsum(self.sizes) - self.sizes)[place]
        unit_ids, ends = gathered(self.values, starts, self.sizes[place], found.of_unit)
        size = np.diff(np.append(0, ends)[np.append(found.start, len(found.of_unit))])
        ids, ends = gathered(unit_ids, np.cumsum(size) - size, size, found.units)
        raw, ends = ids.tobytes(), (4 * np.append(0, ends)[np.append(0, found.ends)]).tolist()
        out = [raw[a:z] for a, z in zip(ends, ends[1:])]
        for k in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[k] = self._whole(texts[k].as_py())
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: pa.Array) -> None:
        """Append words, none of them known, in their order."""
        given = words.to_pylist()
        spaced = [w for w in given if w[0] == " " and not w.isspace()]  # side by side, each begins at its space
        ids = self._side_by_side(spaced) if spaced else {}
        others = [w for w in given if w not in ids]
        for w, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            ids[w] = np.array(e.ids, "<u4").tobytes()
        runs = [ids[w] for w in given]
        self.known = pa.concat_arrays([self.known, words])
        self.values = np.concatenate([self.values, np.frombuffer(b"".join(runs), "<u4")])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, runs), np.int64, len(runs)) // 4])

    def _side_by_side(self, words: list[str]) -> dict[str, bytes]:
        joined = self.tokenizer.encode("".join(words), add_special_tokens=False)
        starts = np.array(joined.offsets, dtype=np.int64)[:, 0]
        cuts = np.searchsorted(starts, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))).tolist()
        raw = np.array(joined.ids, dtype="<u4").tobytes()
        return {w: raw[4 * lo:4 * hi] for w, lo, hi in zip(words, [0, *cuts], cuts)}
