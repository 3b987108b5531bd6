"""Words of texts as a byte-level tokenizer's pattern cuts them, by arrays."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import WHITE_BEFORE_SPACE, gathered


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class Cut:
    """The words of some texts, as numbers into their distinct words.

    A text is cut into units at each space after another character than white space, where a word always begins.
    Distinct units are cut into words by the pattern; units of letters, with full stops or commas behind them,
    without asking it. ``words``: distinct words; the words of unit u are ``of_unit[start[u]:start[u] + size[u]]``;
    the units of text t are ``units[ends[t - 1]:ends[t]]``.
    """

    def __init__(self, pattern: str, texts: pa.Array):
        import regex
        find = regex.compile(pattern).findall
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, WHITE_BEFORE_SPACE)
        parts = pc.split_pattern(texts, " ")
        if odd.true_count:
            split = regex.compile(r"(?<=\S) ").split
            kept = pa.array([split(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.string()))
            at = np.arange(len(texts))
            at[odd.to_numpy(zero_copy_only=False)] = np.arange(len(texts), len(texts) + len(kept))
            parts = pa.concat_arrays([parts, kept]).take(pa.array(at))
        flat = parts.flatten()
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        self.ends = offsets[1:]
        coded = flat.dictionary_encode()
        units = coded.dictionary
        self.units = coded.indices.to_numpy().copy()
        # the beginning of a text has no space before it: a unit of its own for each text
        begins = flat.take(pa.array(offsets[:-1]))
        self.units[offsets[:-1]] = np.arange(len(units), len(units) + len(texts))
        core = pc.utf8_rtrim(units, characters=".,")
        plain = pc.utf8_is_alpha(core).to_numpy(zero_copy_only=False)
        cut_at = pc.binary_length(core).to_numpy(zero_copy_only=False)
        tailed = plain & (pc.binary_length(units).to_numpy(zero_copy_only=False) > cut_at)
        asked = list(map(find, pc.binary_join_element_wise("", units.filter(pa.array(~plain)), " ").to_pylist() + begins.to_pylist()))
        asked_words = pa.array(list(chain.from_iterable(asked)), pa.string())
        stems = pc.binary_join_element_wise("", core.filter(pa.array(plain)), " ")
        tails = pc.replace_substring_regex(units.filter(pa.array(tailed)), r"^[^.,]*", "")
        coded = pa.concat_arrays([stems, tails, asked_words]).dictionary_encode()
        self.words, codes = coded.dictionary, coded.indices.to_numpy()
        self.size = np.zeros(len(units) + len(texts), np.int64)
        self.size[:len(units)][plain] = 1
        self.size[:len(units)][tailed] = 2
        other = np.concatenate([np.flatnonzero(~plain), np.arange(len(units), len(self.size))])
        self.size[other] = np.fromiter(map(len, asked), np.int64, len(asked))
        ends = np.cumsum(self.size)
        self.start = ends - self.size
        self.of_unit = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        a, z = len(stems), len(stems) + len(tails)
        self.of_unit[self.start[:len(units)][plain]] = codes[:a]
        self.of_unit[self.start[:len(units)][tailed] + 1] = codes[a:z]
        asked_at, _ = gathered(np.arange(len(self.of_unit)), self.start, self.size, other)
        self.of_unit[asked_at] = codes[z:]

    def short(self, most: int) -> np.ndarray:
        """Whether each word has at most that many bytes."""
        return pc.binary_length(self.words).to_numpy(zero_copy_only=False) <= most
