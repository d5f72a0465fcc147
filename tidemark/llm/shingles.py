"""Hashed word shingles of a text, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of a text that are hashed at a time; only a longer single word takes more.
BLOCK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of words (split at ASCII white space, A-Z lower-cased) and of runs of ``k`` words."""

    def __init__(self, k: int = 5):
        self.k = k
        self.lower = bytes.maketrans(UPPER, LOWER)
        self.space = np.zeros(256, bool)
        self.space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        self.weights = mixed(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 1 << 14)
            for name, base in (("powers", BASE), ("inverses", BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _blocks(self, data: bytes) -> Iterator[bytes]:
        at = 0
        while len(data) - at > BLOCK:
            end = at + BLOCK
            gaps = np.flatnonzero(self.space[np.frombuffer(data, np.uint8, BLOCK, at)])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < len(data) and not self.space[data[end]]:
                    end += 1
            yield data[at:end]
            at = end
        yield data[at:]

    def words(self, text: str) -> np.ndarray:
        """A 64-bit hash of each word, in order."""
        data = text.encode("utf-8", "surrogatepass").translate(self.lower)
        parts = [self._words(b) for b in self._blocks(data)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _words(self, data: bytes) -> np.ndarray:
        if not data:
            return np.empty(0, np.uint64)
        b = np.frombuffer(data, np.uint8)
        self._grow(len(b) + 1)
        edges = np.flatnonzero(np.diff(self.space[b], prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.powers[: len(b)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mixed(words + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def set(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles; of fewer than k words, the one of all. Without words, none."""
        w = self.words(text or "")
        n = len(w)
        if n == 0:
            return w
        if n < self.k:
            return mixed((w * self.weights[:n]).sum(keepdims=True) + np.uint64(n))
        h = np.zeros(n - self.k + 1, np.uint64)
        for i in range(self.k):
            h += w[i : n - self.k + 1 + i] * self.weights[i]
        return np.unique(mixed(h))


class MinHasher:
    """Minima of many universal hash functions over a set, and hashes of their bands."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, n = bands, rows, bands * rows
        self.a = (rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)[:, None]
        self.mix = mixed(np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 2048):
            np.minimum(out, (self.a * x[i : i + 2048] + self.b).min(axis=1), out=out)
        return out

    def keys(self, signature: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band; keys of different bands differ."""
        s = signature.reshape(self.bands, self.rows).astype(np.uint64)
        band = np.arange(self.bands, dtype=np.uint64)
        return mixed((s * self.mix).sum(axis=1) + mixed(band + np.uint64(1))).view(np.int64)
