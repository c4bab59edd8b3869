"""Sets of word n-grams as hashes, in numpy."""

from __future__ import annotations

import numpy as np

#: Words of an n-gram, and the bits of an n-gram's hash.
N, BITS = 5, 48
#: Bytes hashed at a time.
PIECE = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA5A3564E27F88A35, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> np.ndarray:
    return np.r_[np.uint64(1), np.full(max(0, n - 1), _ODD, np.uint64)].cumprod(dtype=np.uint64)


def _piece_words(raw: np.ndarray) -> np.ndarray:
    space = _SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    place = np.arange(len(raw)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(raw)]))
    value = (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    value[space] = 0
    return _mixed(np.add.reduceat(value, starts))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of every word, A-Z as a-z; the text is cut between words, so memory is bounded by the longest word."""
    raw = np.frombuffer(text, np.uint8)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        while end < len(raw):
            ahead = np.flatnonzero(_SPACE[raw[end : end + PIECE]])
            if len(ahead):
                end += int(ahead[0])
                break
            end = min(len(raw), end + PIECE)
        out.append(_piece_words(raw[at:end]))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: bytes, n: int = N) -> np.ndarray:
    """The sorted distinct hashes (BITS bits, as uint64) of a text's word n-grams; of fewer words the whole sequence is one."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < n:
        joined = (words * _PLACE[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
        return _mixed(joined.reshape(1)) >> np.uint64(64 - BITS)
    joined = sum(words[k : len(words) - n + 1 + k] * _PLACE[k] for k in range(n))
    return np.unique(_mixed(joined) >> np.uint64(64 - BITS))
