"""DartMinHash: signatures of weighted sets whose agreement is their weighted similarity.

Each element owns a strip as wide as its weight, along an axis of ranks. Darts fall on the
plane at one per unit of area; where, only the element decides, so all sets see the same
darts. A set catches the darts that fall on its strips, and each dart belongs to one of `k`
coordinates. A coordinate's value is the caught dart of the least rank. Two sets have equal
values with a probability of their weighted Jaccard similarity,
sum(min(a, b)) / sum(max(a, b)).

Ranks are thrown in order, up to the rank at which a set expects `k (ln k + 2)` darts
(the cost does not depend on `k` times the number of elements). Where a coordinate is
still empty, the limit doubles until it is not.
"""

from __future__ import annotations

import numpy as np

from wordtide.llm.words import mix

_U = np.uint64
_NEXT, _PLACE, _ACROSS = _U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7)


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers above 0, up to 1."""
    return ((x >> _U(11)).astype(np.float64) + 1) * 2.0**-53


def strips(owner: np.ndarray, element: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unit strips of weighted elements: owner, hash and width, which is below 1 for a last part."""
    whole = np.ceil(weight).astype(np.int64)
    nth = np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)
    width = np.minimum(1.0, np.repeat(weight, whole) - nth)
    return np.repeat(owner, whole), mix(np.repeat(element, whole) + mix(nth.astype(np.uint64))), width


def signatures(
    owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n_sets: int, k: int
) -> np.ndarray:
    """`n_sets` x `k` values; an element occurs once in a set, weights are above 0.

    Sets without elements have only zeros.
    """
    owner, state, width = strips(owner, element, weight)
    total = np.bincount(owner, weights=width, minlength=n_sets)
    limit = np.divide(k * (np.log(k) + 2), total, out=np.zeros(n_sets), where=total > 0)
    state = mix(state + _NEXT)
    rank = -np.log(_uniform(state))
    best, value = np.full(n_sets * k, np.inf), np.zeros(n_sets * k, np.uint64)
    active = np.flatnonzero(rank < limit[owner])
    while True:
        slots, ranks, darts = [], [], []
        while len(active):
            now = state[active]
            hit = _uniform(mix(now ^ _ACROSS)) <= width[active]
            caught = active[hit]
            slots.append(owner[caught] * k + (mix(now[hit] ^ _PLACE) % _U(k)).astype(np.int64))
            ranks.append(rank[caught])
            darts.append(now[hit])
            now = mix(now + _NEXT)
            state[active] = now
            rank[active] -= np.log(_uniform(now))
            active = active[rank[active] < limit[owner[active]]]
        if slots:
            slot, at, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
            order = np.lexsort((dart, at, slot))
            slot, at, dart = slot[order], at[order], dart[order]
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else []
            slot, at, dart = slot[first], at[first], dart[first]
            # Later throws have higher ranks than the limit before, so a filled slot stays.
            free = np.isinf(best[slot])
            best[slot[free]], value[slot[free]] = at[free], dart[free]
        empty = np.isinf(best).reshape(n_sets, k).any(axis=1) & (total > 0)
        if not empty.any():
            return value.reshape(n_sets, k)
        limit[empty] *= 2
        active = np.flatnonzero(empty[owner] & (rank < limit[owner]))


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band of `rows` coordinates; keys of different bands differ."""
    n, k = values.shape
    keys = np.zeros((n, k // rows), np.uint64)
    for i in range(rows):
        keys = mix(keys * _NEXT + values[:, i::rows][:, : k // rows])
    return mix(keys + np.arange(1, k // rows + 1, dtype=np.uint64) * _PLACE)
