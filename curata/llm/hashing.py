"""Word and shingle hashing of whole texts, vectorised over Arrow batches.

A word is a maximal run of characters other than space, tab, newline,
vertical tab, form feed and carriage return (``[^\\x20\\x09-\\x0D]+``). Words
are hashed straight from the UTF-8 bytes of a whole batch of texts: a
polynomial prefix sum over all bytes gives every word's hash by one
subtraction, so no Python object is made per word.
"""

from __future__ import annotations

import numpy as np

#: Shared defaults of every operator on word shingles.
SHINGLE_WORDS = 5
SIMILARITY = 0.8

_BASE = np.uint64(0x9E3779B97F4A7C15)      # any odd constant: invertible modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: dict[str, np.ndarray] = {}

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SPACE_OR_MARK = _SPACE.copy()
_SPACE_OR_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        _powers[kind] = have = np.multiply.accumulate(p)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a murmur-style finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """Words of a batch of texts.

    ``hash`` has one 64-bit hash per word; ``first`` (length n + 1) the index
    of each text's first word; ``start``/``end`` the words' byte offsets in
    ``data``; ``offset`` the texts' byte offsets. With ``plain``, texts are
    lower-cased first and ASCII punctuation counts as white space. A null
    text has no words.
    """

    def __init__(self, texts: list[str | None], plain: bool = False):
        raw = [(t.lower() if plain else t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        # one separator byte after each text, so that no word spans two texts
        self.data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
        self.offset = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(r) + 1 for r in raw], out=self.offset[1:])
        space = (_SPACE_OR_MARK if plain else _SPACE)[self.data]
        edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, self.offset)
        self.hash = self._hash(self.data)

    def _hash(self, d: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        block = 1 << 19                       # bytes hashed at a time, to bound memory
        i = 0
        while i < len(self.start):
            lo = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, lo + block, side="right")))
            part = d[lo:self.end[j - 1]].astype(np.uint64) + np.uint64(1)
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(part * _power("up", _BASE, len(part)), out=total[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            out[i:j] = (total[e] - total[s]) * _power("down", _BASE_INVERSE, len(part) + 1)[s]
            i = j
        return mix(out + (self.end - self.start).astype(np.uint64))

    def shingles(self, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words inside a text, and the index of each text's first one (length texts + 1).

        The run at word ``i`` sits at ``first_shingle[text] + i - first[text]``.
        A text of fewer than ``n`` words but at least one has a single
        shingle of all its words; a text without words has none.
        """
        count = np.diff(self.first)
        size = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
        first = np.concatenate(([0], np.cumsum(size)))
        text = np.repeat(np.arange(len(count)), size)
        at = self.first[:-1][text] + (np.arange(first[-1]) - first[:-1][text])
        h = np.zeros(len(at), dtype=np.uint64)
        last = self.first[1:][text] - 1
        for j in range(n):
            w = at + j
            h = h * _STEP + np.where(w <= last, self.hash[np.minimum(w, len(self.hash) - 1)] if len(self.hash) else 0, 0).astype(np.uint64)
        return mix(h), first


def text_slices(texts, max_bytes: int = 2 << 20):
    """Runs ``(from, to)`` of an Arrow string array of about ``max_bytes`` each (one text at least): bounds a task's memory."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > max_bytes:
            yield lo, i
            lo, total = i, 0
        total += int(n)
    if lo < len(sizes):
        yield lo, len(sizes)


def signatures(shingles: np.ndarray, first: np.ndarray, n_hashes: int) -> np.ndarray:
    """MinHash values, one row of ``n_hashes`` 32-bit minima per text (all ones for a text without shingles).

    Hash k maps a shingle's upper 32 bits x to a_k * x + b_k modulo 2**32.
    """
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 32, n_hashes, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, n_hashes, dtype=np.uint32)
    out = np.full((len(first) - 1, n_hashes), 0xFFFFFFFF, dtype=np.uint32)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        at = first[some]
        for k in range(n_hashes):
            out[some, k] = np.minimum.reduceat(x * a[k] + b[k], at)
    return out
