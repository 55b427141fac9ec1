"""Signatures of sets of 64-bit values for banding, for many sets at once."""

from __future__ import annotations

import numpy as np

from spendlens.llm.text import mix

_GOLDEN = 0x9E3779B97F4A7C15


def superminhash(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures, uint64 [sets, size], of sets of distinct values.

    In round j each element draws a rank and the j-th place of its own random permutation of the
    `size` places; a place keeps the least (round, rank) that it is given. Rounds of later number
    cannot improve a place that has a value, so a set is finished, and its elements drop out, in
    the first round after which all its places have one: after one round for large sets. An
    empty set has all ones."""
    n_sets = len(bounds) - 1
    out = np.full(n_sets * size, np.iinfo(np.uint64).max, np.uint64)
    open_places = np.ones(n_sets * size, bool)
    owner = np.repeat(np.arange(n_sets), np.diff(bounds))
    active = values
    order = None  # each active element's permutation, from the second round on
    first = None
    for j in range(size):
        if not len(active):
            break
        draw = mix(active + np.uint64((2 * j + 1) * _GOLDEN % (1 << 64)))
        swap = j + (((draw >> np.uint64(32)) * np.uint64(size - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            place = first = swap
        else:
            row = np.arange(len(active))
            place = order[row, swap].astype(np.int64)
            order[row, swap] = order[:, j]
            order[:, j] = place
        rank = mix(draw + np.uint64(_GOLDEN))
        slot = owner * size + place
        wanted = open_places[slot]
        slot, rank = slot[wanted], rank[wanted]
        np.minimum.at(out, slot, rank)
        open_places[slot] = False
        left = open_places.reshape(n_sets, size).any(axis=1)[owner]
        if j == 0:
            active, owner, first = active[left], owner[left], first[left]
            order = np.tile(np.arange(size, dtype=np.int16), (len(active), 1))
            order[np.arange(len(active)), first] = 0
            order[:, 0] = first
        else:
            active, owner, order = active[left], owner[left], order[left]
    return out.reshape(n_sets, size)


def minhash(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Plain MinHash signatures, uint64 [sets, size]: the least of each of `size` hashes, which are
    the values, hashes themselves, times an odd number."""
    n_sets = len(bounds) - 1
    out = np.full((n_sets, size), np.iinfo(np.uint64).max, np.uint64)
    some = np.diff(bounds) > 0
    if some.any():
        factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
        for j in range(size):
            out[some, j] = np.minimum.reduceat(values * factors[j], bounds[:-1][some])
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """int64 [sets, bands]: a hash of each run of `rows` values and of its number."""
    n_sets, size = signatures.shape
    bands = size // rows
    parts = signatures[:, : bands * rows].reshape(n_sets, bands, rows)
    keys = np.tile(mix(np.arange(bands, dtype=np.uint64)), (n_sets, 1))
    for k in range(rows):
        keys = mix(keys * np.uint64(_GOLDEN) + parts[:, :, k])
    return keys.view(np.int64)
