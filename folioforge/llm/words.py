"""Vectorised words of a batch of texts.

A word is a maximal run of a-z and 0-9 after lower-casing and removing accents (in either Unicode form). A batch is
one array of code points, so no Python object is made for a word: classes come from a table, hashes from sums over runs.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np

DROP = 255  # combining marks: neither part of a word nor its end
_U = np.uint64


@cache
def class_table() -> np.ndarray:
    """Code point -> 0 (separator), 1..36 (a-z, 0-9 without accent) or DROP, by rule from the Unicode data."""
    table = np.zeros(0x110000, np.uint8)
    for cp in (*range(0x20000), *range(0xE0100, 0xE01F0)):
        if unicodedata.category(chr(cp)) == "Mn":
            table[cp] = DROP
    code = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")}
    for cp in range(0x2200):  # no later character decomposes canonically to a-z or 0-9
        base = [c for c in unicodedata.normalize("NFD", chr(cp).lower()) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0].lower() in code:
            table[cp] = code[base[0].lower()]
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SYMBOL = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


@cache
def _powers(n: int) -> np.ndarray:
    p = np.full(n, 0xD6E8FEB86659FD93, _U)
    p[0] = 1
    return np.cumprod(p, dtype=_U)


@dataclass
class Words:
    hashes: np.ndarray  # one 64-bit hash a word
    owner: np.ndarray  # index of the word's text
    first: np.ndarray  # of each text, the index of its first word; one more entry than texts


def words_of(texts: list[str | None]) -> Words:
    """Words of each text in order; null counts as empty."""
    joined = "\n".join([t or "" for t in texts]) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    cls = class_table()[points]
    if (drop := cls == DROP).any():
        kept = np.flatnonzero(~drop)
        cls = cls[kept]
        ends = np.searchsorted(kept, ends)
    at = np.flatnonzero(cls)
    if not len(at):
        return Words(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    opens = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    sizes = np.diff(np.append(opens, len(at)))
    place = np.arange(len(at)) - np.repeat(opens, sizes)
    powers = _powers(1 << int(sizes.max()).bit_length())
    hashes = mix(np.add.reduceat(_SYMBOL[cls[at]] * powers[place], opens) + sizes.astype(_U))
    first = np.concatenate(([0], np.searchsorted(at[opens], ends)))
    return Words(hashes, np.repeat(np.arange(len(texts)), np.diff(first)), first)


def shingles_of(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word runs as (text index, hash), sorted by text, then hash."""
    n = len(w.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    h = w.hashes[:n]
    for j in range(1, k):
        h = mix(h * _U(0x9E3779B97F4A7C15) + w.hashes[j : n + j])
    inside = w.owner[:n] == w.owner[k - 1 :]
    owner, h = w.owner[:n][inside], h[inside]
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return owner[new], h[new]


def slices(batch, column: int, octets: int = 4_000_000):
    """Cut a batch of texts into runs of about `octets` bytes, so that a worker's arrays stay small; a longer text is a run."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // octets
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
