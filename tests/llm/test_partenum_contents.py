"""What the contents of partitions say about two sets."""

from __future__ import annotations

import numpy as np

from tiffin.llm.partenum import _with_partners, contents, may_link, signatures, signatures_of


def drawn(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))


def test_similar_sets_may_link():
    rng = np.random.default_rng(3)
    for n in [*range(5, 400, 9), 3000]:
        a = drawn(rng, n)
        b = np.unique(np.r_[rng.permutation(a)[len(a) // 10 :], drawn(rng, len(a) // 12)])
        both = len(np.intersect1d(a, b))
        if np.array_equal(a, b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        x, y = contents(a, 80), contents(b, 80)
        assert may_link(x, len(a), y, len(b), 80) and may_link(y, len(b), x, len(a), 80)
        assert np.array_equal(signatures_of(x, len(a), 80), signatures(a, 80))


def test_a_shared_passage_is_no_partner():
    """Sets that share a third of their elements share signatures, but their texts are not read for it."""
    rng = np.random.default_rng(4)
    passage = drawn(rng, 60)
    sets = [np.unique(np.r_[passage, drawn(rng, 120)]) for _ in range(30)]
    sets.append(np.unique(np.r_[sets[0][8:], drawn(rng, 8)]))
    assert set(signatures(sets[1], 80).tolist()) & set(signatures(sets[2], 80).tolist())
    held, n, every = [contents(s, 80) for s in sets], np.array([len(s) for s in sets]), np.arange(len(sets))
    assert np.flatnonzero(_with_partners(held, n, every, every, every, 80)).tolist() == [0, 30]
    assert not _with_partners(held, n, np.zeros(len(sets), int), every, every, 80).any()
