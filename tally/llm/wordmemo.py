"""Encoding of many texts word by word, each distinct word once.

Where a tokenizer never joins anything across a blank or a line break, a
text's ids are its words' ids in order. Arrow splits a batch and numbers its
distinct words; only words not met before go to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tally.llm.common import ragged_take, translated

#: Distinct words kept between batches; beyond that the memo starts anew.
MEMO_WORDS = 600_000


_BLANK = bytes(32 if b == 10 else b for b in range(256))
_BLANK_LOWER = bytes(b + 32 if 65 <= b <= 90 else c for b, c in enumerate(_BLANK))


class WordMemo:
    """Ids of words, remembered up to a bound.

    ``encode`` maps a list of distinct words to their lists of ids. With
    ``lower``, A-Z are lower-cased first, for tokenizers that lower-case. With
    ``breaks``, line breaks are kept: each starts a word of its own, for
    tokenizers that give them ids.
    """

    def __init__(self, encode: Callable[[Sequence[str]], list[list[int]]], limit: int = MEMO_WORDS,
                 lower: bool = False, breaks: bool = False) -> None:
        self.encode, self.limit, self.lower, self.breaks = encode, limit, lower, breaks
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = {}
        self.pool = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _known(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words; new ones are encoded."""
        if len(self.number) > self.limit:
            self._reset()
        number = self.number
        fresh = [w for w in words if w not in number]
        if fresh:
            ids = self.encode(fresh)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            starts = len(self.pool) + np.cumsum(lengths) - lengths
            base = len(number)
            number.update(zip(fresh, range(base, base + len(fresh))))
            self.pool = np.concatenate([self.pool, flat])
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the texts in order, ids of each text) for a string column; null is empty."""
        if self.breaks:
            split = pc.split_pattern(pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), "\n", " \n"), " ")
        else:
            split = pc.split_pattern(translated(column, _BLANK_LOWER if self.lower else _BLANK), " ")
        offsets = np.asarray(split.offsets)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = self._known(words)
        at = known[np.asarray(coded.indices)]
        lengths = self.lengths[at]
        flat = ragged_take(self.pool, self.starts[at], lengths)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        offsets = offsets - offsets[0]
        return flat, sums[offsets[1:]] - sums[offsets[:-1]]
