"""Hashes of byte ranges from prefix sums, for whole slices of texts at once."""

from __future__ import annotations

import numpy as np

from talklake.llm.common import worker_state

#: Two polynomials modulo a prime: modulo a power of two, words that alternate in the right way are equal
#: under every base.
_PRIME = (1 << 31) - 1
_P, _SHIFT = np.uint64(_PRIME), np.uint64(31)
_BASES = (1_583_458_089, 784_588_716)
#: A random number per byte value and polynomial, from a fixed seed: every worker has the same.
_BYTES = np.random.default_rng(20240229).integers(1, _PRIME, (2, 256), dtype=np.uint64)


def _reduced(values: np.ndarray) -> np.ndarray:
    """Numbers below 2**62 modulo the prime."""
    values = (values & _P) + (values >> _SHIFT)
    values = (values & _P) + (values >> _SHIFT)
    values[values >= _P] -= _P
    return values


def mixed(values: np.ndarray) -> np.ndarray:
    """The numbers with all bits depending on all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Ranges:
    """Hashes of any byte ranges of one buffer: equal ranges have equal hashes wherever they are."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        size = 1 << max(16, (n - 1).bit_length())
        powers = worker_state("rolling powers")
        if size not in powers:
            powers.clear()
            powers[size] = [(_powers(base, size), _powers(pow(base, -1, _PRIME), size)) for base in _BASES]
        self.down = [down for _, down in powers[size]]
        self.sums = []
        for own, (up, _) in zip(_BYTES, powers[size], strict=True):
            sums = np.zeros(n, np.uint64)
            np.cumsum(_reduced(own[data] * up[: n - 1]), out=sums[1:])
            self.sums.append(_reduced(sums))

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        parts = [_reduced(_reduced(s[ends] + (_P - s[starts])) * d[starts]) for s, d in zip(self.sums, self.down, strict=True)]
        return _hashed(*parts, (ends - starts).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes from each place on."""
        last = len(self.sums[0]) - size
        if last <= 0:
            return np.zeros(0, np.uint64)
        parts = [_reduced(_reduced(s[size:] + (_P - s[:last])) * d[:last]) for s, d in zip(self.sums, self.down, strict=True)]
        return _hashed(*parts, np.uint64(size))


def _hashed(high: np.ndarray, low: np.ndarray, size) -> np.ndarray:
    return mixed(((high << _SHIFT) | low) + size * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, size: int) -> np.ndarray:
    """The first powers of the base, twice as many each time; ``size`` is a power of two."""
    powers = np.ones(1, np.uint64)
    while len(powers) < size:
        powers = np.concatenate([powers, _reduced(powers * np.uint64(pow(base, len(powers), _PRIME)))])
    return powers


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    least, size = values, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - size :])
