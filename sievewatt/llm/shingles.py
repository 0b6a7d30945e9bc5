"""Word shingles of whole texts as 64-bit hashes, computed over byte arrays.

A-Z are lower-cased, words are runs of anything but ASCII white space, and a document's set holds its
distinct runs of ``width`` words; fewer words, but not none, count as one run. Two different runs get the
same hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from sievewatt.llm.common import slices_of

WIDTH = 5
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64
)
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 1 << 18:
            _powers[str(base)] = have
    return have[:n]


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of one piece of text."""
    a = np.frombuffer(data, np.uint8)
    solid = np.zeros(len(a) + 2, bool)
    solid[1:-1] = (a > 32) | (a < 9) | ((a > 13) & (a < 32))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edges[::2], edges[1::2]
    upto = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(a)), out=upto[1:])
    return start, mix((upto[end] - upto[start]) * _power(_INVERSE, len(a) + 1)[start])


def word_hashes(text: str, piece: int = 1 << 18) -> np.ndarray:
    """Hash of every word of one text, in order; long texts go piece by piece, cut between words."""
    data = text.encode("utf-8", "surrogatepass").lower()
    out, at = [], 0
    while at < len(data):
        end = at + piece
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        out.append(_words(data[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _runs(words: np.ndarray, counts: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Distinct run hashes, sorted, per document; ``words`` holds the documents' words one after the other."""
    ends = np.cumsum(counts)
    if len(words) >= width:
        run = np.zeros(len(words) - width + 1, np.uint64)
        for j in range(width):
            run += words[j : len(words) - width + 1 + j] * _ODD[j % 5] + np.uint64(j)
        run = mix(run)
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if n >= width:
            own = np.sort(run[end - n : end - width + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif n:
            short = np.uint64(n)
            for w in words[end - n : end]:
                short = mix(np.array([short * _ODD[0] + w], np.uint64))[0]
            yield np.array([short], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def sets_of(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The set of every text, in order; null and blank texts have empty sets."""
    with np.errstate(over="ignore"):
        for begin, end in slices_of(texts):
            own = texts[begin:end]
            if len(own) == 1:
                words = word_hashes(own[0] or "")
                yield from _runs(words, np.array([len(words)]), width)
                continue
            parts = [(t or "").encode("utf-8", "surrogatepass") for t in own]
            data = b"\n".join(parts).lower()
            start, words = _words(data)
            ends = np.cumsum([len(p) + 1 for p in parts])
            counts = np.diff(np.concatenate(([0], np.searchsorted(start, ends))))
            yield from _runs(words, counts, width)
