"""Word shingles of many texts at once, as 64-bit fingerprints (numpy)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WIDTH = 5
#: Bytes of text handled at once inside a task.
CHUNK = 1 << 20
#: Bytes whose running sums are held at once, also within one long text.
PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)                         # odd, so invertible mod 2^64
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)


_POWERS: dict[str, np.ndarray] = {}


def _table(base: np.uint64, size: int) -> np.ndarray:
    p = np.full(size, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of at least ``n`` powers; longer ones, for a long word, are not kept."""
    if n > PIECE:
        return _table(_BASE, n), _table(_BACK, n)
    if not _POWERS:
        _POWERS.update(up=_table(_BASE, PIECE), down=_table(_BACK, PIECE))
    return _POWERS["up"], _POWERS["down"]


def _word_values(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of the bytes from ``first`` to ``end`` of every word, which
    does not depend on the word's place: pieces of the text are summed apart."""
    value, a = np.empty(len(first), np.uint64), 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(end, first[a] + PIECE - 1)))
        low = first[a]
        part = raw[low:end[b - 1]]
        up, down = _powers(len(part) + 1)
        running = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_byte_values()[part] * up[:len(part)], out=running[1:])
        value[a:b] = (running[end[a:b] - low] - running[first[a:b] - low]) * down[first[a:b] - low]
        a = b
    return value


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, owner, first and end byte (in its text) of every word of the texts;
    words are runs of bytes other than ASCII white space."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    gap = _SPACE[raw]
    edge = np.flatnonzero(np.diff(gap, prepend=True))
    first, end = edge[::2], edge[1::2]                        # the text ends in a gap
    value = _word_values(raw, first, end)
    owner = np.searchsorted(begin, first, "right") - 1
    return (mix64(value + (end - first).astype(np.uint64)), owner,
            first - begin[owner], end - begin[owner])


_PLACE = [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(1, 9)]


def shingles_of(words: np.ndarray, owner: np.ndarray, texts: int, width: int = WIDTH) \
        -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each text's shingles of ``width`` words; a shorter
    text with words has one shingle of them all."""
    first = np.searchsorted(owner, np.arange(texts + 1))
    count = np.diff(first)
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        total += words[k:k + len(total)] * _PLACE[k]
    at = np.flatnonzero(owner[:len(total)] == owner[width - 1:]) if len(total) else \
        np.zeros(0, np.int64)
    total = total[at]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            whole[has] += words[first[short][has] + k] * _PLACE[k]
        total = np.concatenate([total, whole + count[short].astype(np.uint64)])
        at = np.concatenate([at, first[short]])
        order = np.argsort(at, kind="stable")
        total, at = total[order], at[order]
    return mix64(total), at


def chunks(texts: list[bytes]):
    """Index ranges of about ``CHUNK`` bytes; one longer text is a range."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield a, b
            a, size = b, 0
        size += len(t) + 1
    if texts:
        yield a, len(texts)


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z counts as a-z."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts):
        words, owner, _, _ = words_of([t.lower() for t in texts[a:b]])   # ASCII letters only
        values, at = shingles_of(words, owner, b - a, width)
        stop = np.searchsorted(owner[at], np.arange(b - a + 1))
        for i in range(b - a):
            own = np.sort(values[stop[i]:stop[i + 1]])
            out.append(own[np.diff(own, prepend=~own[:1]) != 0] if len(own) else own)
    return out
