"""Word shingles and SuperMinHash signatures of one document, in numpy."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each byte at each of 64 places in a word.
_TABLE = mix(np.arange(256 * 64, dtype=np.uint64).reshape(256, 64) + np.uint64(0x243F6A8885A308D3))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word between ASCII blanks, by tabulation over its bytes.

    A byte's value comes from a table by its place in the word; each further 64 places count with another odd factor.
    """
    a = np.frombuffer(text, np.uint8)
    word = ~((a == 32) | ((a >= 9) & (a <= 13)))
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = np.diff(np.append(starts, len(a)))
    place = np.arange(starts[0], len(a)) - np.repeat(starts, lengths)
    values = _TABLE[a[starts[0]:], place & 63]
    if lengths.max() > 64:
        values = values * ((place >> 6) * 2 + 1).astype(np.uint64)
    values[~word[starts[0]:]] = 0
    return mix(np.add.reduceat(values, starts - starts[0]))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words, A-Z lower-cased.

    With fewer words the whole sequence is one shingle; without any there is none.
    """
    h = word_hashes((text or "").encode().lower())
    n = len(h)
    if not n:
        return h
    k = min(words, n)
    out = h[:n - k + 1].copy()
    for j in range(1, k):
        out *= _MULTIPLIER
        out += h[j:n - k + 1 + j]
    return np.unique(mix(out + np.uint64(k)))


def super_minhash(shingles: np.ndarray, size: int) -> np.ndarray:
    """The SuperMinHash signature of a set of 64-bit hashes, as 32-bit integers.

    Every element carries a random permutation of the ``size`` places and a random number for each of its
    ranks; place p gets the least rank (then number) at which any element visits it. Going rank by rank over all
    elements, a place once filled can only get worse values later, so the search ends with the rank that fills
    the last place: after two or three ranks for a set larger than ``size``. Element by element, the same
    signature would come from stopping at the largest rank in the signature.

    Equal places of two signatures estimate the Jaccard similarity with less variance than independent minima.
    """
    none = np.uint32(0xFFFFFFFF)
    out = np.full(size, none, np.uint32)
    for at in range(0, len(shingles), _CHUNK):
        np.minimum(out, _signature(shingles[at:at + _CHUNK], size), out=out)
    return out


def _signature(x: np.ndarray, size: int) -> np.ndarray:
    none = np.uint32(0xFFFFFFFF)
    out = np.full(size, none, np.uint32)
    # Fisher-Yates: the rank-th place is drawn from those not visited yet. Large sets need few ranks, for
    # which the swaps so far are followed back; small ones keep the permutations as a table.
    table = len(x) < 256
    rows = np.arange(len(x)) if table else None
    places = np.broadcast_to(np.arange(size, dtype=np.uint16), (len(x), size)).copy() if table else None
    picks: list[np.ndarray] = []
    for rank in range(size):
        r = mix(x + np.uint64((rank + 1) * int(_MULTIPLIER) & 0xFFFFFFFFFFFFFFFF))
        pick = rank + ((r >> np.uint64(40)) % np.uint64(size - rank)).astype(np.intp)
        if table:
            place = places[rows, pick].astype(np.intp)
            places[rows, pick] = places[:, rank]
            places[rows, rank] = place
        else:
            place = pick
            for j in range(rank - 1, -1, -1):
                place = np.where(place == picks[j], j, place)
            picks.append(pick)
        value = (np.uint32(rank) << np.uint32(22)) | (r & np.uint64((1 << 22) - 1)).astype(np.uint32)
        open_ = out == none
        if rank == 0:
            np.minimum.at(out, place, value)
        else:
            use = open_[place]
            np.minimum.at(out, place[use], value[use])
        if not (out == none).any():
            break
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of consecutive signature places."""
    rows = len(signature) // bands
    s = signature[:bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(rows):
        key = mix(key * _MULTIPLIER + s[:, j] + np.uint64(1))
    return key.view(np.int64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
