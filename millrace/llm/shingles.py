"""Word shingles of whole texts as 64-bit hashes, for a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS = 5
U = np.uint64
#: Odd multipliers; any odd 64-bit constants do, but they must never change between the two sides of a comparison.
BASE = 0x9E3779B97F4A7C15
WORD_MULT = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=U)
CHUNK_BYTES = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """base**i and base**-i modulo 2**64, grown to the longest chunk seen."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 20)
            inverse = pow(BASE, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up, self.down = (np.concatenate([np.ones(1, dtype=U), np.cumprod(np.full(size, b, dtype=U))]) for b in (BASE, inverse))
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lower-cased and split at space and \\x09-\\x0D, and each text's first word."""
    raw = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    at = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] if len(texts) else np.zeros(0, dtype=np.int64)
    if not len(raw):
        return np.zeros(0, dtype=U), np.zeros(len(texts) + 1, dtype=np.int64)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]])))
    start, end = edge[::2], edge[1::2]
    up, down = _POWERS.get(len(raw))
    total = np.concatenate([np.zeros(1, dtype=U), np.cumsum((low.astype(U) + U(1)) * up[: len(raw)], dtype=U)])
    words = mix((total[end] - total[start]) * down[start] + (end - start).astype(U))
    return words, np.concatenate([np.searchsorted(start, at), [len(start)]])


def _sequence(words: np.ndarray) -> np.ndarray:
    """One hash for each row of consecutive words: their number matters as well."""
    return mix((words * WORD_MULT[: words.shape[1]]).sum(axis=1, dtype=U) + U(words.shape[1]))


def shingle_sets(texts: Sequence[str | None], k: int = WORDS) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles, sorted: of k words, or one of all words if there are fewer."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    at = 0
    with np.errstate(over="ignore"):
        while at < len(raw):
            to, size = at + 1, len(raw[at])
            while to < len(raw) and size + len(raw[to]) < CHUNK_BYTES:
                size += len(raw[to])
                to += 1
            words, first = word_hashes(raw[at:to])
            n = len(words)
            whole = _sequence(np.lib.stride_tricks.sliding_window_view(words, k)) if n >= k else np.zeros(0, dtype=U)
            for a, b in zip(first[:-1], first[1:]):
                if b - a >= k:
                    yield np.unique(whole[a : b - k + 1])
                elif b > a:
                    yield _sequence(words[None, a:b])
                else:
                    yield np.zeros(0, dtype=U)
            at = to


#: Sets travel between tasks as their whole hashes.
def to_bytes(shingles: np.ndarray) -> bytes:
    return shingles.astype("<u8").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u8")
