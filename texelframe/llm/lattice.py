"""The E8 lattice: nearest points and neighbouring points of many vectors at once."""

from __future__ import annotations

import itertools

import numpy as np


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(axis=1) % 2 != 0)
    if len(odd):
        miss = x[odd] - f[odd]
        worst = np.argmax(np.abs(miss), axis=1)
        f[odd, worst] += np.where(miss[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: whole, or whole and a half, coordinates, of even sum."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def roots() -> np.ndarray:
    """The 240 shortest vectors: differences between neighbouring points."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)
