"""Rolling hashes over the code points of many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, a bijection of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, extended on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, _U)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 19)
            for name, base in (("up", self.base), ("down", self.inverse)):
                values = np.full(size, base, _U)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up[:n], self.down[:n]


_BASES = (_Powers(0x5851F42D4C957F2D), _Powers(0xD1342543DE82EF95))


class Rolling:
    """Hashes of any stretch of a sequence of code points, independent of where it stands."""

    def __init__(self, points: np.ndarray, base: int = 0):
        n = len(points)
        up, self._down = _BASES[base].of(n + 1)
        self._sums = np.zeros(n + 1, _U)
        np.cumsum(mixed(points.astype(_U) + _U(0x9E3779B97F4A7C15)) * up[:n], out=self._sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """The hash of each stretch of ``k`` code points."""
        if len(self._sums) <= k:
            return np.zeros(0, _U)
        return mixed((self._sums[k:] - self._sums[:-k]) * self._down[: len(self._sums) - k])

    def stretches(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The hash of each stretch, which also depends on its length."""
        return mixed((self._sums[starts + lengths] - self._sums[starts]) * self._down[starts] + mixed(lengths.astype(_U)))


def code_points(texts: Iterable[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(texts: list[str], most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``most`` characters each, to bound the arrays made of them."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)
