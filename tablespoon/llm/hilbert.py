"""Position on a Hilbert curve, for a batch of points at once."""

from __future__ import annotations

import numpy as np


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index (int64) of integer ``cells`` of shape (points, axes), each in [0, 2**bits).

    Needs ``axes * bits <= 63``. The cell coordinates are turned into the curve's
    transposed index by exchanging and inverting low bits from the highest bit down,
    then Gray-decoded; the bits of all axes are interleaved at the end.
    """
    points, axes = cells.shape
    if axes * bits > 63:
        raise ValueError("a key has 63 bits at most")
    x = [cells[:, a].astype(np.int64) for a in range(axes)]
    for bit in range(bits - 1, 0, -1):
        high, low = np.int64(1 << bit), np.int64((1 << bit) - 1)
        for a in range(axes):
            flips = (x[a] & high) != 0
            swap = np.where(flips, 0, (x[0] ^ x[a]) & low)
            x[0] = np.where(flips, x[0] ^ low, x[0] ^ swap)
            if a:
                x[a] = x[a] ^ swap
    for a in range(1, axes):
        x[a] = x[a] ^ x[a - 1]
    turn = np.zeros(points, dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> bit) & 1 != 0, turn ^ np.int64((1 << bit) - 1), turn)
    key = np.zeros(points, dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for a in range(axes):
            key = (key << 1) | (((x[a] ^ turn) >> bit) & 1)
    return key
