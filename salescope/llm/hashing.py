"""Vectorised 64-bit hashes of words and word shingles over whole batches of text.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z read
as a-z.  Its hash is a polynomial in the word's bytes, modulo 2**64, taken
from one running sum over the batch, then mixed.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_STEP = 1 << 20

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_VALUE = np.arange(1, 257, dtype=_U)
_VALUE[ord("A") : ord("Z") + 1] += _U(32)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(max(n, _STEP + 1024), base, dtype=_U)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words of each text."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = IS_WORD[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, text after text, and the number of words of each text."""
    starts, ends, counts = word_spans(data, offsets)
    out, i = np.empty(len(starts), _U), 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, low + _STEP)))
        high = ends[j - 1]
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, _U)
        np.cumsum(_VALUE[data[low:high]] * up[: high - low], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(_U)
        i = j
    return mix(out), counts


def shingle_sets(words: np.ndarray, counts: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each text the ascending distinct hashes of its word shingles; a text
    of fewer words gives its whole sequence as one, an empty text none."""
    keys = mix(np.arange(1, size + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
    n = len(words)
    sums = np.zeros(max(0, n - size + 1), _U)
    for j in range(size if n >= size else 0):
        sums += words[j : n - size + 1 + j] * keys[j]
    sums, out, at = mix(sums), [], 0
    for c in counts.tolist():
        if c >= size:
            s = np.sort(sums[at : at + c - size + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif c:
            out.append(mix((words[at : at + c] * keys[:c]).sum(dtype=_U, keepdims=True) + _U(c)))
        else:
            out.append(np.empty(0, _U))
        at += c
    return out
