"""Words of many texts at once, as bytes.

A word is a longest run of digits, letters A-Z (lower-cased) or a-z, and characters beyond ASCII; all other ASCII
characters part words.  In UTF-8 every byte of a character beyond ASCII is 128 or more, so bytes can be judged alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .shared import padded

#: Each byte lower-cased, or 0 where it is in no word.
FOLD = np.zeros(256, np.uint8)
FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
FOLD[ord("A") : ord("Z") + 1] = FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[128:] = np.arange(128, 256)


class Words(NamedTuple):
    """The words of some texts in order; text i has the words ``cuts[i]`` to ``cuts[i + 1]``."""

    data: np.ndarray  # the words' bytes, one after the other
    offsets: np.ndarray  # word j has the bytes offsets[j] to offsets[j + 1]
    cuts: np.ndarray
    begins: np.ndarray  # where each word begins in its text, in bytes
    ends: np.ndarray

    def array(self) -> pa.Array:
        return binary_array(self.data, self.offsets)

    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data, np.uint8))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def split_words(parts: list[bytes]) -> Words:
    buffer, starts, stops = padded(parts, b" ")
    folded = FOLD[buffer]
    inside = folded != 0
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    cuts = np.append(0, np.searchsorted(begins, stops)) if parts else np.zeros(1, np.int64)
    shift = np.repeat(starts, np.diff(cuts))
    return Words(folded[inside], np.append(0, np.cumsum(ends - begins)), cuts, begins - shift, ends - shift)
